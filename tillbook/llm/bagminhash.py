"""Signatures of weighted sets whose slots agree with the probability of the weighted Jaccard similarity.

Every element has a hierarchy of Poisson processes, one for each of the weight intervals (0, 1], (1, 2],
(2, 4], (4, 8], ... A point of such a process has a time, a weight within the interval and a slot, all
from hashes of the element. An element of weight w brings in its points of weight below w, so that the
smaller of two weights brings in a part of the points of the larger. A slot keeps its earliest point. Only
points up to a time are made at which a slot is hardly ever empty; where one is, that time is doubled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tillbook.llm.common import PLACE, Words, mix

SHINGLE = 5
BANDS, ROWS = 32, 6
SLOTS = BANDS * ROWS

_TIER = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0xE7037ED1A0B428DB)
_SLACK = 3.0


def _times(k: int, of: np.uint64) -> np.uint64:
    """The k-th multiple of a constant, within 64 bits."""
    return np.uint64(k * int(of) % 2**64)


@dataclass
class Bags:
    """Distinct shingles and their counts; those of text ``i`` are ``first[i]:first[i + 1]``, sorted."""

    first: np.ndarray
    shingles: np.ndarray
    counts: np.ndarray

    def ids(self) -> list[bytes | None]:
        """16 bytes that stand for the whole bag; None for an empty one."""
        weight = self.counts.astype(np.uint64)
        parts = [mix(self.shingles ^ mix(weight + _times(k, _TIER))) for k in (1, 2)]
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(p)]) for p in parts]
        pair = np.stack([s[self.first[1:]] - s[self.first[:-1]] for s in sums], axis=1)
        return [p.tobytes() if a < b else None for p, a, b in zip(pair, self.first[:-1], self.first[1:], strict=True)]


def bags_of(words: Words) -> Bags:
    """The five-word shingles of each text as a bag; all words of a shorter text are one shingle."""
    at, value = words.windows(SHINGLE)
    begins = np.searchsorted(at, words.first)
    shingles, counts, first = [], [], [0]
    for i, n in enumerate(words.counts):
        if n >= SHINGLE:
            own, times = np.unique(value[begins[i] : begins[i + 1]], return_counts=True)
        elif n:
            own = mix((words.hashes[words.first[i] : words.first[i + 1]] * PLACE[:n]).sum(keepdims=True) + np.uint64(n))
            times = np.ones(1, np.int64)
        else:
            own, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        shingles.append(own)
        counts.append(times)
        first.append(first[-1] + own.size)
    join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return Bags(np.array(first), join(shingles, np.uint64), join(counts, np.int64))


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _fill(seed: np.ndarray, low: np.ndarray, length: np.ndarray, weight: np.ndarray, row: np.ndarray, until: np.ndarray, slots: int, times: np.ndarray, names: np.ndarray) -> None:
    """Puts all points up to ``until[row]`` into the slots of their rows."""
    rate = slots * length
    # Most processes have no point in time: one comparison of hash bits refuses them.
    first = mix(seed + _STEP)
    chance = np.exp(-rate * until[row])
    alive = np.flatnonzero((first >> np.uint64(11)) >= (chance * 2.0**53).astype(np.uint64))
    seed, low, length, weight, row, rate = (x[alive] for x in (seed, low, length, weight, row, rate))
    bits, now, step = first[alive], np.zeros(alive.size), 1
    while True:
        now = now - np.log(_uniform(bits)) / rate
        on = np.flatnonzero(now <= until[row])
        if not on.size:
            return
        if on.size < now.size:
            seed, low, length, weight, row, rate, now, bits = (x[on] for x in (seed, low, length, weight, row, rate, now, bits))
        name = mix(bits ^ _TIER)
        place = low + length * ((name & np.uint64(2**32 - 1)).astype(np.float64) * 2.0**-32)
        slot = row * slots + ((name >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        inside = place < weight
        slot, when, name = slot[inside], now[inside], mix(name)[inside]
        earlier = when < times[slot]
        slot, when, name = slot[earlier], when[earlier], name[earlier]
        np.minimum.at(times, slot, when)
        won = times[slot] == when
        names[slot[won]] = name[won]
        step += 1
        bits = mix(seed + _times(step, _STEP))


def signatures(bags: Bags, slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` names of 16 bits per text; zeros for an empty bag."""
    n = bags.first.size - 1
    times = np.full(n * slots, np.inf)
    names = np.zeros(n * slots, dtype=np.uint64)
    row = np.repeat(np.arange(n), np.diff(bags.first))
    weight = bags.counts.astype(np.float64)
    total = np.bincount(row, weights=weight, minlength=n)
    until = (np.log(slots) + _SLACK) / np.maximum(total, 1)
    # One process per element and weight interval that the element reaches into.
    tiers = [(bags.shingles, row, weight, 0.0, 1.0)]
    low = 1.0
    while (reach := np.flatnonzero(weight > low)).size:
        tiers.append((bags.shingles[reach], row[reach], weight[reach], low, low))
        low *= 2
    parts = [
        (mix(s + _times(k, _TIER)), np.full(s.size, a), np.full(s.size, b), w, r)
        for k, (s, r, w, a, b) in enumerate(tiers)
    ]
    seed, lows, lengths, weight, row = (np.concatenate(x) for x in zip(*parts, strict=True))
    todo = np.ones(n, dtype=bool)
    todo[total == 0] = False
    while todo.any():
        own = np.flatnonzero(todo[row])
        _fill(seed[own], lows[own], lengths[own], weight[own], row[own], until, slots, times, names)
        empty = np.isinf(times.reshape(n, slots)).any(axis=1) & (total > 0)
        todo = empty
        until = np.where(empty, until * 2, until)
    return (names >> np.uint64(48)).astype(np.uint16).reshape(n, slots)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sizes of intersection and union of two bags, given as sorted shingles and counts."""
    if a[0].size > b[0].size:
        a, b = b, a
    at = np.searchsorted(b[0], a[0])
    at[at == b[0].size] = 0
    same = b[0][at] == a[0]
    both = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both
