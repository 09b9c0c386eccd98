"""Periodic runs of words within documents, by Lyndon roots from Baier's grouping of suffixes.

A run is a maximal stretch of words with a smallest period q, of at least ``copies`` periods and ``least``
words. Every document is handled alone, by the task that holds it, so nothing is shuffled and no key can
be hot. Of its words, only stretches in which every three words recur often enough go through
``lyndon.runs``: inside a run of c copies (and 2 c - 2 words or more) the three words from any place on are
found at least c - 1 times, so a run always lies whole in one such stretch and no run is lost.

Words are told apart by 64-bit hashes: two different words of one document are taken for the same with a
probability of the square of their number in 2^65.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import map_text
from tillbook.llm.lyndon import runs
from tillbook.llm.plainwords import SPACE, PlainWords

#: A run has so many periods and so many words at least.
COPIES, LEAST = 4, 6
#: What every place of a run shares with others of it.
WINDOW = 3

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def _stretches(words: PlainWords, copies: int) -> list[tuple[int, int]]:
    """Begin and end of the stretches of words that can hold runs; each lies in one text."""
    at = words.repeated_windows(WINDOW, copies - 1)
    if not at.size:
        return []
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [at.size - 1]])]
    return list(zip(first.tolist(), (last + WINDOW).tolist(), strict=True))


def find_runs(words: PlainWords, copies: int, least: int) -> np.ndarray:
    """Rows (first word, length, period) of all runs of some texts, in order; words count through all texts."""
    found = []
    for begin, end in _stretches(words, copies):
        if end - begin >= least:
            found += [(begin + s, n, p) for s, n, p in runs(words.hashes[begin:end], copies, least)]
    return np.array(found, dtype=np.int64).reshape(-1, 3)


def _collapsed(words: PlainWords, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    document = words.document()[kept]
    begin, end = words.begin[kept], words.end[kept].copy()
    if document.size:
        end[:-1] += document[1:] == document[:-1]  # the white space after a word stands for the space
    change = np.zeros(words.data.size + 2, dtype=np.int8)
    change[begin] += 1
    change[end] -= 1
    data = words.data[np.cumsum(change[: words.data.size], dtype=np.int8) > 0]
    data[SPACE[data]] = 32
    sizes = np.bincount(document, weights=end - begin, minlength=words.counts.size).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    made = pa.LargeStringArray.from_buffers(words.counts.size, pa.py_buffer(offsets), pa.py_buffer(data))
    return made.cast(pa.string())


def collapse_runs(
    docs: DataFrame, *, text: str = "text", keep: Sequence[str] | None = None, copies: int = COPIES, least: int = LEAST
) -> DataFrame:
    """Columns ``keep`` (default: all), n_words, runs (by start, then period) and collapsed, for every row.

    ``copies`` is 3 or more, and ``least`` at least 2 ``copies`` - 2. A word is dropped from ``collapsed`` if any
    run holds it after the run's first period. Starts count words from 0. A null, empty or blank text has no
    words, no runs and an empty collapsed text; repeated rows give repeated rows; a very long text is one
    task's work, linear in its length. Input columns named like a result give way to it.
    """
    if copies < 3 or least < 2 * copies - 2:
        raise ValueError("copies must be 3 or more, and least 2 * copies - 2 or more")
    new = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType()),
    ])

    def step(texts: pa.Array) -> list[pa.Array]:
        words = PlainWords(texts)
        found = find_runs(words, copies, least)
        change = np.zeros(words.begin.size + 1, dtype=np.int64)
        np.add.at(change, found[:, 0] + found[:, 2], 1)
        np.add.at(change, found[:, 0] + found[:, 1], -1)
        kept = np.cumsum(change[:-1]) == 0
        document = np.searchsorted(words.first, found[:, 0], side="right") - 1
        starts = found[:, 0] - words.first[document]
        rows = pa.StructArray.from_arrays([pa.array(c) for c in (starts, found[:, 1], found[:, 2])], names=RUN.fieldNames())
        offsets = np.concatenate([[0], np.cumsum(np.bincount(document, minlength=len(texts)))])
        listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
        return [pa.array(words.counts), listed, _collapsed(words, kept)]

    return map_text(docs, text, docs.columns if keep is None else keep, new, lambda: step)


def repeat_words(text: Column, doc_id: Column) -> Column:
    """The texts with a planted period in about one document of ten, chosen and shaped by the checksum of its id.

    With h the checksum, g = h div 10 and h % 10 = 0, word i from a = g % n on becomes word a + (i - a) % p, where
    p = 1 + (n - a) div (3 + g % 8). Other texts, and those of a null id, stay as they are.
    """
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    seed = F.floor(checksum / 10)

    def planted(words: Column) -> Column:
        n = F.size(words).cast("long")
        start = seed % n
        period = 1 + F.floor((n - start) / (3 + seed % 8))
        place = lambda i: F.when(i < start, i).otherwise(start + (i - start) % period)
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int"))), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # The list of words is made once per text: the inner function sees it as its argument.
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return F.when(checksum % 10 == 0, F.get(changed, F.lit(0))).otherwise(text)
