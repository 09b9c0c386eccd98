"""Benchmark decontamination: a prefix-filtered containment join of documents with benchmark windows.

Every run of 13 words of a benchmark item (the whole item, if shorter) is a window. A window lies in a
document only if all its shingles do, so one of them is a sufficient prefix: the rarest over the whole
corpus. Documents are joined with these prefix shingles by hash; the place of a shingle in its window
gives the only possible start, which must leave room for the window's length; then the words are compared.

The documents stay where they are: only benchmark windows travel, as broadcast blocks of at most
``block_bytes`` of benchmark text (or one longer item). The driver and each Python worker hold a block as
arrays: about 20 times its text while it is built, 8 times after. A larger benchmark is taken in several blocks, one pass
each, whose marks are joined per document in a stored table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.llm.common import Words, document_of, fields, map_text, pieces, prepare, stored

WINDOW = 13
SHINGLE = 5
BLOCK_BYTES = 16 << 20

_MARKS = fields(marks="binary", found="strings", n_words="long")
_FILTER_BITS = 22


@dataclass
class Windows:
    """The distinct windows of one block of items, as arrays that can be broadcast.

    ``data`` holds the items' words, a space between those of one item; word ``p`` is ``data[begin[p]:end[p]]``.
    Window ``w`` is the ``sizes[w]`` words from ``at[w]`` on, and stands in the items
    ``names[i]`` for i in ``item[first[w]:first[w + 1]]``. ``shingle[p]`` is the hash of the shingle that begins at
    word ``p``; only the driver needs it.
    """

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    at: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    names: list[str]
    shingle: np.ndarray
    shingle_sizes: list[int]

    def text(self, w: int) -> bytes:
        """The words of a window, joined by a space."""
        at = self.at[w]
        return self.data[self.begin[at] : self.end[at + self.sizes[w] - 1]].tobytes()

    def shingles(self) -> np.ndarray:
        """How many shingles each window has, one behind the other from its first word on."""
        return self.sizes.astype(np.int64) - np.minimum(SHINGLE, self.sizes) + 1


def _joined(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased words with one space between those of a text, and where each word begins and ends."""
    more = np.ones(words.begin.size, dtype=np.int64)
    more[words.first[1:][words.counts > 0] - 1] = 0  # the last word of a text
    size = words.end - words.begin
    end = np.cumsum(size + more) - more
    change = np.zeros(words.lower.size + 2, dtype=np.int8)
    change[words.begin] += 1
    change[words.end + more] -= 1
    data = words.lower[np.cumsum(change[: words.lower.size], dtype=np.int8) > 0]
    data[end[more > 0]] = 32
    return data, (end - size).astype(np.int32), end.astype(np.int32)


def item_windows(ids: pa.Array, texts: pa.Array) -> Windows:
    """All windows of the given items, equal ones once with the items that hold them."""
    words = Words(texts)
    names = [i if i is not None else "" for i in ids.cast(pa.string()).to_pylist()]
    item = np.repeat(np.arange(len(names)), words.counts)
    rest = words.first[1:][item] - np.arange(item.size)  # words from here to the end of the item
    size = np.minimum(WINDOW, words.counts)[item]
    k = np.minimum(SHINGLE, words.counts)[item]
    shingle = np.zeros(item.size, dtype=np.uint64)
    for n in np.unique(k):
        at, value = words.windows(int(n))
        own = k[at] == n
        shingle[at[own]] = value[own]
    at = np.flatnonzero(rest >= size)
    sizes, hashes = size[at].astype(np.int8), np.zeros(at.size, dtype=np.uint64)
    for n in np.unique(sizes):
        place, value = words.windows(int(n))
        own = sizes == n
        hashes[own] = value[np.searchsorted(place, at[own])]
    item = item[at]
    data, begin, end = _joined(words)
    out = Windows(data, begin, end, at.astype(np.int32), sizes, hashes, np.zeros(1, np.int32), np.zeros(0, np.int32), names, shingle, [int(n) for n in np.unique(k)])

    order = np.lexsort((at, hashes))
    new = np.ones(at.size, dtype=bool)
    new[1:] = hashes[order][1:] != hashes[order][:-1]
    group = np.cumsum(new) - 1
    kept = order[new]
    apart = [w for w, g in zip(order[~new].tolist(), group[~new].tolist(), strict=True) if out.text(w) != out.text(kept[g])]
    of = np.empty(at.size, dtype=np.int64)
    of[order] = group
    of[apart] = kept.size + np.arange(len(apart))  # other words under the same hash are windows of their own
    kept = np.concatenate([kept, np.array(apart, dtype=np.int64)])
    held = np.unique(of * max(len(names), 1) + item)
    out.first = np.searchsorted(held, np.arange(kept.size + 1) * max(len(names), 1)).astype(np.int32)
    out.item = (held % max(len(names), 1)).astype(np.int32)
    out.at, out.sizes, out.hashes = out.at[kept], sizes[kept], hashes[kept]
    return out


NO_WINDOWS = item_windows(pa.array([], pa.string()), pa.array([], pa.string()))


class Lookup:
    """Places of 64-bit keys in a sorted array; most other values are refused by one bit test."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.bits[keys >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which values are keys, and which keys they are."""
        if not self.keys.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bits[values >> np.uint64(64 - _FILTER_BITS)])
        place = np.minimum(np.searchsorted(self.keys, values[maybe]), self.keys.size - 1)
        right = self.keys[place] == values[maybe]
        return maybe[right], place[right]


def shingle_documents(docs: DataFrame, text: str, keys: np.ndarray, sizes: list[int]) -> np.ndarray:
    """For each sorted key, the number of documents that hold this shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value)
        seen = np.zeros(lookup.keys.size, dtype=np.int64)
        for batch in batches:
            for piece in pieces(batch, 0):
                words = Words(piece.column(0))
                for size in sizes:
                    at, value = words.windows(size)
                    hit, key = lookup.find(value)
                    pair = document_of(words.first, at[hit]) * lookup.keys.size + key
                    seen += np.bincount(np.unique(pair) % lookup.keys.size, minlength=lookup.keys.size)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["key", "n"])

    texts = docs.select(F.col(f"`{text}`").cast("string"))
    counted = texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    shared.unpersist()
    out = np.zeros(keys.size, dtype=np.int64)
    out[counted["key"].to_numpy()] = counted["n"].to_numpy()
    return out


@dataclass
class Prefixes:
    """Sorted prefix shingles; ``windows[first[p]:first[p + 1]]`` start ``places`` words before shingle ``p``."""

    keys: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    places: np.ndarray


def rarest_prefixes(windows: Windows, keys: np.ndarray, documents: np.ndarray) -> Prefixes:
    """The rarest shingle of every window; of equally rare ones the first in key order."""
    rank = np.empty(keys.size, dtype=np.int64)
    rank[np.lexsort((keys, documents))] = np.arange(keys.size)
    of_word = rank[np.searchsorted(keys, windows.shingle)] if keys.size else np.zeros(0, np.int64)
    many = windows.shingles()
    best, place = np.full(many.size, keys.size, dtype=np.int64), np.zeros(many.size, dtype=np.int8)
    for o in range(int(many.max(initial=0))):
        own = np.flatnonzero(many > o)
        found = of_word[windows.at[own] + o]
        less = found < best[own]
        best[own[less]], place[own[less]] = found[less], o
    chosen = windows.shingle[windows.at + place]
    order = np.argsort(chosen, kind="stable").astype(np.int32)
    unique, first = np.unique(chosen[order], return_index=True)
    return Prefixes(unique, np.append(first, order.size).astype(np.int32), order, place[order])


def find_windows(words: Words, windows: Windows, prefixes: Prefixes, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of every window that occurs in the texts."""
    starts, numbers = [], []
    for size in windows.shingle_sizes:
        at, value = words.windows(size)
        hit, key = lookup.find(value)
        many = prefixes.first[key + 1] - prefixes.first[key]
        post = np.repeat(prefixes.first[key], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        number = prefixes.windows[post]
        place = np.repeat(at[hit], many)
        document = document_of(words.first, place)
        start = place - prefixes.places[post]
        fits = (start >= words.first[document]) & (start + windows.sizes[number] <= words.first[document + 1])
        fits &= np.minimum(SHINGLE, windows.sizes[number]) == size
        starts.append(start[fits])
        numbers.append(number[fits])
    start, number = np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(numbers or [np.zeros(0, np.int64)])
    same = np.zeros(start.size, dtype=bool)
    for size in np.unique(windows.sizes[number]):
        own = np.flatnonzero(windows.sizes[number] == size)
        at, value = words.windows(int(size))
        same[own] = value[np.searchsorted(at, start[own])] == windows.hashes[number[own]]
    right = [i for i in np.flatnonzero(same) if words.bytes_of(start[i], windows.sizes[number[i]]) == windows.text(number[i])]
    return start[right], number[right]


def mark_block(docs: DataFrame, text: str, keep: list[str], block: Windows, only: bool = False) -> DataFrame:
    """``keep``, and per document: a bit per word that is hit, the items found, the number of words.

    If the block is the only one, the columns of ``RESULT`` come instead, from the same Python worker.
    """
    spark = docs.sparkSession
    prepare(spark)
    whole = np.zeros(block.shingle.size + 1, dtype=np.int64)
    np.add.at(whole, block.at, 1)
    np.add.at(whole, block.at + block.shingles(), -1)
    keys = np.unique(block.shingle[np.cumsum(whole[:-1]) > 0])  # of the places that are in a window
    prefixes = rarest_prefixes(block, keys, shingle_documents(docs, text, keys, block.shingle_sizes))
    shared = spark.sparkContext.broadcast((replace(block, shingle=NO_WINDOWS.shingle), prefixes))

    def start():
        windows, chosen = shared.value
        lookup = Lookup(chosen.keys)

        def step(texts: pa.Array) -> list[pa.Array]:
            words = Words(texts)
            begin, number = find_windows(words, windows, chosen, lookup)
            change = np.zeros(words.begin.size + 1, dtype=np.int64)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + windows.sizes[number], -1)
            hit = np.cumsum(change)[:-1] > 0
            marks: list[bytes | None] = [None] * len(texts)
            found: list[list[str]] = [[] for _ in marks]
            document = document_of(words.first, begin)
            for d in np.unique(document):
                marks[d] = np.packbits(hit[words.first[d] : words.first[d + 1]]).tobytes()
                found[d] = sorted({windows.names[i] for w in np.unique(number[document == d]) for i in windows.item[windows.first[w] : windows.first[w + 1]]})
            if only:
                return _summary([[m] for m in marks], found, words.counts.tolist())
            return [pa.array(marks, pa.binary()), pa.array(found, pa.list_(pa.string())), pa.array(words.counts)]

        return step

    return map_text(docs, text, keep, RESULT if only else _MARKS, start)


def _hits(marks: list[bytes | None]) -> int:
    bits = [np.frombuffer(m, np.uint8) for m in marks if m]
    return int(np.unpackbits(np.bitwise_or.reduce(bits)).sum()) if bits else 0


def _summary(marks: list[list[bytes | None]], found: list[list[str]], n: list[int]) -> list[pa.Array]:
    """The columns of ``RESULT``, from the marks and items of each document in all blocks."""
    items = [sorted(set(i)) for i in found]
    n_hit = [_hits(m) for m in marks]
    digest = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]
    bad = [h > 0 and 20 * h >= w for h, w in zip(n_hit, n, strict=True)]
    made = [pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(i) for i in items], pa.int64())]
    return made + [pa.array(digest, pa.string()), pa.array(bad, pa.bool_()), pa.array(items, pa.list_(pa.string()))]


def _summaries(marked: DataFrame, new: T.StructType) -> DataFrame:
    schema = T.StructType([marked.schema["row"], *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = _summary(*(batch.column(c).to_pylist() for c in ("marks", "found", "n_words")))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *made], names=schema.names)

    return marked.select("row", "marks", "found", "n_words").mapInArrow(run, schema)


RESULT = fields(
    n_words="long", n_hit="long", n_items="long", items_sha256="string", contaminated="boolean", items="strings"
)


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[Windows]:
    """The benchmark in parts of about ``block_bytes`` of text, each small enough for the driver."""
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").cast("string").alias("text"))
    items = items.where(F.col("text").isNotNull())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = math.ceil(size / block_bytes)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else items
        rows = part.toArrow()
        yield item_windows(rows["item"].combine_chunks(), rows["text"].combine_chunks())


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Columns ``keep`` (default: all) and: n_words, n_hit (words inside any window's occurrence), n_items,
    items_sha256, contaminated (some word is hit, and at least a twentieth of all), items (sorted).

    One row per input row, repeated ones too. A null or empty text has no words; an item without words has
    no window; an item id that is null counts as the empty string; equal ids count once. With an empty
    benchmark nothing is hit. Input columns named like a result give way to it.
    """
    names = {f.name.lower() for f in RESULT}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in names]
    row = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text")]
    rows = docs.select(*row)
    # One entry of marks for each block that has been matched.
    state = rows.withColumns({"marks": F.array().cast("array<binary>"), "found": F.array().cast("array<string>")})
    blocks = _blocks(benchmark, item, item_text, block_bytes)
    block, later = next(blocks, NO_WINDOWS), next(blocks, None)
    if later is None:
        out = mark_block(rows, "text", ["row"], block, only=True)
        return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[f.name for f in RESULT])
    while True:
        carry = state.select("row", "text", F.col("marks").alias("old_marks"), F.col("found").alias("old_found"))
        kept = ["row", "old_marks", "old_found", *(["text"] if later else [])]
        now = mark_block(carry, "text", kept, block)
        joined = {"marks": F.concat("old_marks", F.array("marks")), "found": F.concat("old_found", "found")}
        state = now.withColumns(joined).drop("old_marks", "old_found")
        if later is None:
            break
        state = stored(state, "marks")
        block, later = later, next(blocks, None)
    out = _summaries(state, RESULT)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[f.name for f in RESULT])
