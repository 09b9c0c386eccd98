"""Statistics of whole texts for quality rules: counts of words, symbols, repeated lines and repeated windows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillbook.llm.common import fields, map_text
from tillbook.llm.plainwords import SPACE, PlainWords, covered

#: Words of a window; a window found so often in a text is a repeated one.
WINDOW, TIMES = 3, 2

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".,;:?!'\"()-"]] = True
_UPPER, _DIGIT, _LETTER = (np.zeros(256, dtype=bool) for _ in range(3))
_UPPER[65:91] = _DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that the transformed statistics rest on; letters are bytes.
MORE = ("n_lines", "n_stops", "n_upper", "n_digits", "n_letters")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags each text has."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(upto[offsets])


class _Lines(PlainWords):
    """The lines of some texts, split at each line feed, in place of words."""

    def __init__(self, words: PlainWords) -> None:
        self.data, self.offsets, self.lower = words.data, words.offsets, words.data
        feeds = np.flatnonzero(self.data == 10)
        cuts = np.concatenate([self.offsets[:-1], feeds + 1])
        ends = np.concatenate([self.offsets[1:], feeds])
        self.begin, self.end = np.sort(cuts), np.sort(ends)
        with_word = np.searchsorted(words.begin, self.begin) < np.searchsorted(words.begin, self.end)
        self.begin, self.end = self.begin[with_word], self.end[with_word]
        self.first = np.searchsorted(self.begin, self.offsets)
        self.counts = np.diff(self.first)
        self.hashes = self._hash()


def _repeated_lines(lines: _Lines) -> np.ndarray:
    """Lines of each text that equal an earlier one of it; found by hash, then compared byte by byte."""
    n = np.zeros(lines.counts.size, dtype=np.int64)
    again = np.unique(np.searchsorted(lines.first, lines.repeated_windows(1, 2), side="right") - 1)
    for t in again.tolist():
        own = range(lines.first[t], lines.first[t + 1])
        n[t] = len(own) - len({lines.data[lines.begin[k] : lines.end[k]].tobytes() for k in own})
    return n


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` and ``MORE`` of each text; a null or empty text has zeros."""
    words = PlainWords(texts)
    lines = _Lines(words)
    of = lambda table: _per_text(table[words.data], words.offsets)
    character = (words.data & 0xC0) != 0x80
    repeated = covered(words.repeated_windows(WINDOW, TIMES), WINDOW, words.begin.size)
    upto = np.concatenate([[0], np.cumsum(repeated, dtype=np.int64)])
    return {
        "n_words": words.counts,
        "word_chars": _per_text(character & ~SPACE[words.data], words.offsets),
        "n_symbols": of(_SYMBOL),
        "n_dup_lines": _repeated_lines(lines),
        "n_repeat_words": np.diff(upto[words.first]),
        "n_lines": lines.counts, "n_stops": of(_STOP), "n_upper": of(_UPPER), "n_digits": of(_DIGIT), "n_letters": of(_LETTER),
    }


def with_counts(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` and all counts."""

    def step(texts: pa.Array) -> list[pa.Array]:
        counts = text_counts(texts)
        return [pa.array(counts[c].astype(np.int64)) for c in (*COUNTS, *MORE)]

    return map_text(docs, text, keep, fields(**dict.fromkeys((*COUNTS, *MORE), "long")), lambda: step)


