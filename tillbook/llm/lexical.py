"""Ranked lexical search over a length-stratified index.

Scores depend on a document only through its normaliser m and its counts of the terms. The index groups the
documents by equal m; within such a stratum, postings lie by term and count (tf), so that the impact of a
count on a score is computed once per count and stratum. A stratum's greatest count of each term bounds
what any of its documents can score. Each query visits its most promising strata first, which gives a
threshold, and then only strata whose bound reaches it; inside a task strata go by their bounds, and the
threshold rises with what is found.

Documents are dealt out by range of (m, row), so that a stratum of any size is cut into parts of at most
``ROWS`` documents, each with bounds of its own. Queries come in blocks of about ``block_bytes`` of text (or
one longer query); a block's terms are what a task holds besides one part of the index. Words are told
apart by 64-bit hashes: any of a block's v terms is mixed up with one of d other words of the corpus with
a probability of about v * d / 2^64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import Words, fields, map_text, prepare, stored, stored_parts

#: Documents of one part of a stratum.
ROWS = 1024
#: Strata that each query visits first, to find its threshold.
FIRST = 4
#: Text of the queries that are searched for at once.
BLOCK_BYTES = 4 << 20
#: Bounds (of parts and queries) that a task holds at once.
CELLS = 1 << 22
#: Sums of whole numbers below this are exact in double precision.
EXACT = float(2**53)


@dataclass
class Terms:
    """The terms of a block of queries: sorted hashes; per query its terms, how often it has each, and its row."""

    hashes: np.ndarray
    first: np.ndarray
    term: np.ndarray
    times: np.ndarray
    rows: np.ndarray

    def __len__(self) -> int:
        return self.rows.size


def query_terms(texts: pa.Array, rows: np.ndarray) -> Terms:
    """The terms of some query texts; those without any are left out."""
    words = Words(texts)
    hashes, term = np.unique(words.hashes, return_inverse=True)
    query = np.repeat(np.arange(len(texts)), words.counts)
    key, times = np.unique(query * max(hashes.size, 1) + term, return_counts=True)
    query, term = np.divmod(key, max(hashes.size, 1))
    own, first = np.unique(query, return_index=True)
    return Terms(hashes, np.append(first, query.size), term, times.astype(np.int64), rows[own])


def _count_terms(docs: DataFrame, doc: str, text: str, shared) -> DataFrame:
    """Per document with any term: doc_id, n (terms with repeats), and terms and tfs of those that are asked for."""

    def start():
        hashes = shared.value.hashes

        def step(texts: pa.Array) -> list[pa.Array]:
            words = Words(texts)
            place = np.searchsorted(hashes, words.hashes) if hashes.size else np.zeros(words.hashes.size, np.int64)
            known = np.flatnonzero(hashes[np.minimum(place, hashes.size - 1)] == words.hashes) if hashes.size else np.zeros(0, np.int64)
            document = np.repeat(np.arange(len(texts)), words.counts)[known]
            key, tf = np.unique(document * max(hashes.size, 1) + place[known], return_counts=True)
            document, term = np.divmod(key, max(hashes.size, 1))
            offsets = pa.array(np.searchsorted(document, np.arange(len(texts) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int64())) for v in (term, tf)]
            return [pa.array(words.counts), *lists]

        return step

    named = docs.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_text(named, "text", ["doc_id"], fields(n="long", terms="longs", tfs="longs"), start).where("n > 0")


def _document_counts(counted: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term; added up within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(total[term])], names=["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    sums = counted.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in sums.collect():  # at most one row for each term of the block
        out[row["term"]] = row["df"]
    return out


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """What a count of a term adds to a score in stratum ``m``, before its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


_PART = "m long, docs array<long>, top_terms array<long>, top_tfs array<long>, terms array<long>, tfs array<long>, sizes array<long>, places array<int>"


def _strata(counted: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The index: parts of strata, with the greatest count of each term, and postings by term and count."""
    m = F.expr(f"75L + (25L * n * {n_docs}L) div {n_terms}L")
    rows = counted.where("size(terms) > 0").select(m.alias("m"), "row", "doc_id", "terms", "tfs")
    # The row is part of the key: a stratum that fills many tasks is cut, and stays in order.
    rows = rows.repartitionByRange("m", "row").sortWithinPartitions("m", "row").drop("row")

    def part(m: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        terms, tfs = (rows[c].combine_chunks() for c in ("terms", "tfs"))
        place = np.repeat(np.arange(rows.num_rows), np.diff(terms.offsets.to_numpy()))
        term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        order = np.lexsort((place, tf, term))
        term, tf, place = term[order], tf[order], place[order]
        new = np.ones(term.size, dtype=bool)
        new[1:] = (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])
        at = np.flatnonzero(new)
        last = np.flatnonzero(np.append(term[at][1:] != term[at][:-1], True))
        lists = (term[at][last], tf[at][last], term[at], tf[at], np.diff(np.append(at, term.size)), place.astype(np.int32))
        made = [pa.array([m]), pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64()))]
        made += [pa.array([v], pa.list_(pa.int32() if v.dtype == np.int32 else pa.int64())) for v in lists]
        names = ["m", "docs", "top_terms", "top_tfs", "terms", "tfs", "sizes", "places"]
        return pa.RecordBatch.from_arrays(made, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = None, [], 0
        for batch in batches:
            ms = batch.column("m").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(ms[1:] != ms[:-1]) + 1, [ms.size]]) if ms.size else np.zeros(1, np.int64)
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                while begin < end:
                    if held and (own != ms[begin] or size == ROWS):
                        yield part(own, held)
                        held, size = [], 0
                    own, take = int(ms[begin]), min(end - begin, ROWS - size)
                    held.append(batch.slice(begin, take))
                    begin, size = begin + take, size + take
        if held:
            yield part(own, held)

    return rows.mapInArrow(run, _PART).withColumn("part", F.monotonically_increasing_id())


class _Block:
    """The queries of a block with their weights, as a task uses them."""

    def __init__(self, terms: Terms, weights: np.ndarray) -> None:
        self.terms, self.weights = terms, weights
        self.gain = terms.times * weights[terms.term]

    def bounds(self, m: int, top_terms: np.ndarray, top_tfs: np.ndarray) -> np.ndarray:
        """The most that a document of the part can score, per query."""
        most = np.zeros(self.weights.size, dtype=np.int64)
        most[top_terms] = impacts(top_tfs, m)
        return np.add.reduceat(self.gain * most[self.terms.term], self.terms.first[:-1])


class _Top:
    """The k best (score, then smaller doc_id, null last) per query so far."""

    def __init__(self, queries: int, k: int, least: np.ndarray) -> None:
        self.k = k
        self.least = np.maximum(least, 1)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64),) * 3 for _ in range(queries)]

    def add(self, query: int, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        near = np.flatnonzero(score >= self.least[query])
        if not near.size:
            return
        if near.size > 4 * self.k:  # the k-th best of these alone is a threshold already
            kth = np.partition(score[near], near.size - self.k)[near.size - self.k]
            near = near[score[near] >= kth]
        score, doc, null = (np.concatenate([a, b[near]]) for a, b in zip(self.found[query], (score, doc, null), strict=True))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.found[query] = score[order], doc[order], null[order]
        if order.size == self.k:
            self.least[query] = max(self.least[query], score[order[-1]])


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _list(batch: pa.RecordBatch, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _visit(index: DataFrame, shared, k: int, only_first: bool) -> DataFrame:
    """The k best documents per query of each task: query, doc_id, score.

    With ``only_first`` a query visits only the parts named for it; else those whose bound reaches its threshold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, least, first = shared.value
        terms = block.terms
        top = _Top(len(terms), k, least)
        for batch in _slices(batches, max(1, CELLS // max(len(terms), 1))):
            ms, part_ids = (batch.column(c).to_numpy() for c in ("m", "part"))
            bounds = np.array([block.bounds(int(ms[r]), _list(batch, "top_terms", r), _list(batch, "top_tfs", r)) for r in range(batch.num_rows)])
            for r in np.argsort(-bounds.max(axis=1, initial=0), kind="stable").tolist() if batch.num_rows else ():
                queries = first.get(int(part_ids[r]), ()) if only_first else np.flatnonzero(bounds[r] >= top.least).tolist()
                if len(queries):
                    _score(block, bounds[r], int(ms[r]), batch, r, queries, top)
        sizes = [s.size for s, _, _ in top.found]
        score, doc, null = (np.concatenate([f[i] for f in top.found] or [np.zeros(0, np.int64)]) for i in range(3))
        query = np.repeat(np.arange(len(terms)), sizes)
        made = [pa.array(query), pa.array(terms.rows[query]), pa.array(doc, mask=null.astype(bool)), pa.array(score)]
        yield pa.RecordBatch.from_arrays(made, names=["query", "query_row", "doc_id", "score"])

    return index.mapInArrow(run, "query long, query_row long, doc_id long, score long")


def _score(block: _Block, bounds: np.ndarray, m: int, batch: pa.RecordBatch, row: int, queries: list[int], top: _Top) -> None:
    """Scores all documents of a part for some queries, term by term."""
    ids = batch.column("docs")[row].values
    null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
    docs = ids.fill_null(0).to_numpy()
    term, tf, size, place = (_list(batch, c, row) for c in ("terms", "tfs", "sizes", "places"))
    counts, which = np.unique(tf, return_inverse=True)
    value = np.repeat(block.weights[term] * impacts(counts, m)[which], size)  # each impact computed once per count
    upto = np.concatenate([[0], np.cumsum(size)])
    held, at = np.unique(term, return_index=True)
    begin, end = np.zeros(block.weights.size, np.int64), np.zeros(block.weights.size, np.int64)
    begin[held], end[held] = upto[at], upto[np.append(at[1:], term.size)]
    for q in queries:
        own = slice(block.terms.first[q], block.terms.first[q + 1])
        spans = [(b, e, t) for b, e, t in zip(begin[block.terms.term[own]].tolist(), end[block.terms.term[own]].tolist(), block.terms.times[own].tolist(), strict=True) if e > b]
        if not spans:
            continue
        places = np.concatenate([place[b:e] for b, e, _ in spans])
        values = np.concatenate([value[b:e] * t if t > 1 else value[b:e] for b, e, t in spans])
        if bounds[q] < EXACT:
            score = np.bincount(places, weights=values, minlength=docs.size).astype(np.int64)
        else:
            score = np.zeros(docs.size, dtype=np.int64)
            np.add.at(score, places, values)
        top.add(q, score, docs, null)


def _most_promising(index: DataFrame, shared, k: int) -> DataFrame:
    """query, part: the parts of the greatest bounds of each query; reads no postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, _, _ = shared.value
        n = len(block.terms)
        best, part = np.zeros((n, 0), dtype=np.int64), np.zeros((n, 0), dtype=np.int64)
        for batch in _slices(batches, max(1, CELLS // max(n, 1))):
            ms, ids = (batch.column(c).to_numpy() for c in ("m", "part"))
            own = [block.bounds(int(ms[r]), _list(batch, "top_terms", r), _list(batch, "top_tfs", r)) for r in range(batch.num_rows)]
            best, part = np.column_stack([best, *own]), np.column_stack([part, np.broadcast_to(ids, (n, ids.size))])
            order = np.argsort(-best, axis=1, kind="stable")[:, :k]
            best, part = np.take_along_axis(best, order, 1), np.take_along_axis(part, order, 1)
        query = np.repeat(np.arange(n), best.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(part.ravel()), pa.array(best.ravel())], names=["query", "part", "bound"])

    found = index.select("m", "part", "top_terms", "top_tfs").mapInArrow(run, "query long, part long, bound long")
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "part")
    return found.withColumn("place", F.row_number().over(order)).where((F.col("place") <= k) & (F.col("bound") > 0)).select("query", "part")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, doc: str, text: str, terms: Terms, k: int) -> DataFrame:
    """query_row, rank, doc_id and score of the best documents of every query of a block."""
    context = docs.sparkSession.sparkContext
    counted = _count_terms(docs, doc, text, context.broadcast(terms)).withColumn("row", F.monotonically_increasing_id())
    counted = stored(counted, "term-counts")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _document_counts(counted, terms.hashes.size)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in df], dtype=np.int64)
    block = _Block(terms, weights)
    index = stored(_strata(counted, n_docs, max(n_terms, 1)), "strata")

    none = np.zeros(len(terms), dtype=np.int64)
    promising = stored(_most_promising(index, context.broadcast((block, none, {})), FIRST), "first-strata")
    first: dict[int, list[int]] = {}
    for row in promising.collect():  # FIRST of each query
        first.setdefault(row["part"], []).append(row["query"])
    named = index.join(promising.select("part").distinct(), "part", "left_semi").select(*index.columns)
    least = none.copy()
    for row in _best(_visit(named, context.broadcast((block, none, first)), k, True), k).where(F.col("rank") == k).collect():  # one of each
        least[row["query"]] = row["score"]
    return _best(_visit(index, context.broadcast((block, least, {})), k, False), k).drop("query")


def search(
    docs: DataFrame, queries: DataFrame, *, doc: str = "doc_id", text: str = "text", query: str = "item_id", query_text: str = "text",
    k: int = 20, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id (under the name of ``query``), rank (int), doc_id and score of the k best documents of every query row.

    Fewer than k, if fewer have a score above 0; none for a query without terms. Equal scores go by doc_id, null
    last; documents that repeat rank each, and so do queries. Null and blank texts have no terms. Whatever
    other columns there are is left alone.
    """
    prepare(docs.sparkSession)
    asked = queries.select(F.col(f"`{query}`").alias("item"), F.col(f"`{query_text}`").cast("string").alias("text"))
    asked = stored(asked.where("text IS NOT NULL").withColumn("query_row", F.monotonically_increasing_id()), "queries")
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))

    def one(i: int) -> DataFrame:
        own = asked.where(F.pmod(F.xxhash64("query_row"), F.lit(blocks)) == i).select("query_row", "text").orderBy("query_row").toArrow()
        terms = query_terms(own["text"].combine_chunks(), own["query_row"].to_numpy())
        return _search_block(docs, doc, text, terms, k)

    found = one(0) if blocks == 1 else stored_parts(map(one, range(blocks)), "ranked")
    return found.join(asked.select("query_row", F.col("item").alias(query)), "query_row").select(query, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
