"""Words as they are written: the runs of anything but ASCII white space, found on the bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tillbook.llm.common import Words, mix, text_bytes

#: ``[\x20\x09-\x0D]``, by byte.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


class PlainWords(Words):
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, with nothing lower-cased."""

    def __init__(self, texts: pa.Array, hashes: bool = True) -> None:
        self.data, self.offsets = text_bytes(texts)
        self.lower = self.data
        edges = np.zeros(self.data.size + 1, dtype=bool)
        edges[self.offsets] = True
        inside = np.concatenate([[False], ~SPACE[self.data], [False]])
        self.begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edges[:-1]))
        self.end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edges[1:])) + 1
        self.first = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.first)
        if hashes:
            self.hashes = self._hash()

    def document(self) -> np.ndarray:
        """The number of the text of every word."""
        return np.repeat(np.arange(self.counts.size), self.counts)

    def repeated_windows(self, size: int, times: int) -> np.ndarray:
        """First words, in order, of the windows of ``size`` words that their text holds at least ``times`` times."""
        at, value = self.windows(size)
        if not at.size:
            return at
        document = np.searchsorted(self.first, at, side="right").astype(np.uint64)
        key = mix(value + document * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        fresh = np.ones(key.size, dtype=bool)
        fresh[1:] = key[order][1:] != key[order][:-1]
        group = np.cumsum(fresh) - 1
        return np.sort(at[order[np.bincount(group)[group] >= times]])


def covered(spans: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words that begins at one of ``spans``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, spans, 1)
    np.add.at(change, np.minimum(spans + size, n), -1)
    return np.cumsum(change[:-1]) > 0
