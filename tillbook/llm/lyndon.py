"""Lyndon arrays by the first phase of Baier's suffix sorter, and the runs of a sequence from them.

The first phase groups the suffixes of a sequence by their longest Lyndon prefix. It starts from one group
per symbol and goes through the groups from the greatest down. When a group is taken, the suffixes just
before its members (the nearest earlier ones that are still in smaller groups) grow by the group's prefix,
as many times as they stand before members of it, and move to a new group right behind their old one. At
the end the length of a suffix's group prefix is its entry of the Lyndon array, and suffixes share a group
exactly if their longest Lyndon prefixes are equal.

A run (a maximal stretch with a period of at most half its length) has, under one of the two orders of the
symbols, a Lyndon root that is the longest Lyndon word wherever it stands inside the run. Roots are thus
read off the two arrays and extended to both sides as far as symbols one period apart are equal.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(symbols: list[int], n_symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The Lyndon array, and the number of the final group of each suffix, for symbols 0 to ``n_symbols`` - 1."""
    group = list(symbols)
    members: list[list[int]] = [[] for _ in range(n_symbols)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    length = [1] * n_symbols
    size = [len(m) for m in members]
    below, above = list(range(-1, n_symbols - 1)), [*range(1, n_symbols), -1]
    # The nearest suffix, from a place to the left, that no group taken so far holds.
    left = list(range(len(group)))
    current = n_symbols - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        for i in own:
            left[i] = i - 1
        before: dict[int, int] = {}
        for i in own:
            j = left[i]
            while j >= 0 and left[j] != j:
                further = left[j]
                if further >= 0:
                    left[j] = left[further]
                j = further
            left[i] = j
            if j >= 0:
                before[j] = before.get(j, 0) + 1
        moves: dict[int, dict[int, list[int]]] = {}
        for j, times in before.items():
            moves.setdefault(group[j], {}).setdefault(times, []).append(j)
        for old, by_times in moves.items():
            for times in sorted(by_times, reverse=True):
                moved = by_times[times]
                grown = length[old] + times * length[current]
                if len(by_times) == 1 and len(moved) == size[old]:
                    length[old] = grown  # the whole group grows alike and keeps its place
                    continue
                new, up = len(length), above[old]
                length.append(grown)
                size.append(len(moved))
                size[old] -= len(moved)
                members.append(moved)
                for j in moved:
                    group[j] = new
                below.append(old)
                above.append(up)
                above[old] = new
                below[up] = new  # a smaller group always has one above it: that which is taken now, at the latest
        current = below[current]
    final = np.asarray(group, dtype=np.int64)
    return np.asarray(length, dtype=np.int64)[final], final


def _reach(symbols: np.ndarray, at: int, period: int) -> int:
    """The first place from ``at`` on whose symbol differs from that one period later."""
    n, step = symbols.size - period, 64
    while at < n:
        to = min(n, at + step)
        other = symbols[at:to] != symbols[at + period : to + period]
        if other.any():
            return at + int(other.argmax())
        at, step = to, 2 * step
    return n


def runs(symbols: np.ndarray, copies: int = 2, least: int = 0) -> list[tuple[int, int, int]]:
    """All maximal ``(start, length, period)`` of at least ``copies`` periods and ``least`` symbols, in order.

    ``period`` is the smallest one. With two copies these are all runs of the sequence; ``copies`` is 2 or more.
    """
    n = symbols.size
    _, ranks = np.unique(symbols, return_inverse=True)
    n_symbols = int(ranks.max(initial=-1)) + 1
    back = ranks[::-1]
    found = set()
    for order in (ranks, n_symbols - 1 - ranks):
        period, group = lyndon_groups(order.tolist(), n_symbols)
        place = np.arange(n)
        root = np.ones(n, dtype=bool)
        # A run of e periods holds e - 1 roots one after the other; the first of such a row stands for it.
        for k in range(1, copies - 1):
            later = place + k * period
            inside = later < n
            root &= inside
            root[inside] &= group[later[inside]] == group[inside]
        previous = place - period
        inside = previous >= 0
        root[inside] &= group[previous[inside]] != group[inside]
        for i, p in zip(np.flatnonzero(root).tolist(), period[root].tolist(), strict=True):
            end = _reach(ranks, i, p) + p
            # Backwards, place i - 1 and the one a period later are the same as in the reversed sequence.
            start = n - (_reach(back, n - i - p, p) + p)
            if end - start >= max(copies * p, least):
                found.add((start, end - start, p))
    return sorted(found)
