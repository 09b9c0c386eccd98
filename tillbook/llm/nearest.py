"""Nearest vectors by inner product over randomly rotated one-bit codes.

The index keeps for each vector, less the mean of all, the signs of its coordinates after a seeded random
rotation, packed into bits, its length, and how well the signs point along it. From these a query's inner
product is estimated together with a bound of the error. Each task goes through its part of the index in
blocks; vectors whose upper bound reaches the task's current k-th best score are scored on the original
vectors. Only k rows per query leave a task. Queries come in broadcast blocks of a fixed number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import prepare, stored, stored_parts

#: The error of an estimate exceeds its bound with a probability of about 6e-5.
DEVIATIONS = 4.0
#: Queries broadcast at once.
QUERY_BLOCK = 4096
#: In a task, so many vectors are compared with so many queries at once, and so many pairs scored.
ROW_BLOCK, QUERY_PART, PAIRS = 2048, 256, 1 << 14
#: Sums in another order than that of the components differ by less, as a part of the vectors' lengths.
ROUNDING = 1e-12
SEED = 20


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same for a size and a seed."""
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))[0]


@dataclass
class Space:
    """What codes and queries share: the dimension, the mean vector and the rotation's seed."""

    size: int
    mean: np.ndarray
    seed: int = SEED


def usable(vectors: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part: no null, zero or non-finite ones."""
    rows = vectors.select(F.col(f"`{vector_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0)
    )


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, size)


def build_index(vectors: DataFrame, *, vector_id: str = "vec_id", vector: str = "embedding", seed: int = SEED) -> tuple[DataFrame, Space]:
    """The stored index (row_id, vec_id, vector, code, length, along) of all rows that take part.

    Vectors of another length than most (of equally frequent lengths the least) take no part.
    """
    rows = usable(vectors, vector_id, vector)
    most = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "size").first()
    size, n = (most["size"], most["n"]) if most else (1, 1)
    rows = rows.where(F.size("vector") == size)
    prepare(vectors.sparkSession)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += _matrix(batch.column(0), size).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["place", "value"])

    mean = np.zeros(size)
    for row in rows.select("vector").mapInArrow(sums, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        mean[row["place"]] = row["value"] / n
    space = Space(size, np.round(mean, 9), seed)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(space.size, space.seed)
        for batch in batches:
            rest = _matrix(batch.column("vector"), size) - space.mean
            length = np.linalg.norm(rest, axis=1)
            turned = rest @ turn.T
            along = np.abs(turned).sum(axis=1) / np.sqrt(size) / np.where(length > 0, length, 1)
            code = np.packbits(turned > 0, axis=1)
            made = [pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(np.where(length > 0, along, 1.0))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), *made], names=["vec_id", "vector", "code", "length", "along"])

    schema = "vec_id long, vector array<double>, code binary, length double, along double"
    index = rows.mapInArrow(encode, schema).withColumn("row_id", F.monotonically_increasing_id())
    return stored(index, "index"), space


def exact(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows ``i`` of one matrix with rows ``j`` of another, added up in the order of the components."""
    out = np.zeros(i.size)
    for k in range(a.shape[1]):
        out += a[i, k] * b[j, k]
    return out


class Best:
    """The k best (score, then smaller id) of every query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.vec = np.full((queries, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        """More scores, any number per query."""
        own = np.unique(query)
        query = np.concatenate([np.repeat(own, self.k), query])
        score = np.concatenate([self.score[own].ravel(), score])
        vec = np.concatenate([self.vec[own].ravel(), vec])
        order = np.lexsort((vec, -score, query))
        first = np.searchsorted(query[order], own)
        top = order[(first[:, None] + np.arange(self.k)).ravel()]
        self.score[own] = score[top].reshape(-1, self.k)
        self.vec[own] = vec[top].reshape(-1, self.k)


def _search_block(index: DataFrame, space: Space, rows: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """query_row, vec_id and score of the k best of each task."""
    shared = index.sparkSession.sparkContext.broadcast((rows, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_rows, vectors = shared.value
        size = space.size
        turned = (vectors @ rotation(size, space.seed).T).astype(np.float32)
        from_mean = (vectors @ space.mean).astype(np.float32)
        reach = (np.linalg.norm(vectors, axis=1) * DEVIATIONS / np.sqrt(max(size - 1, 1))).astype(np.float32)
        best = Best(len(vectors), k)

        sizes = np.linalg.norm(vectors, axis=1)

        def score(query: np.ndarray, place: np.ndarray, own: np.ndarray, ids: np.ndarray) -> None:
            # On the original vectors; the order of the components is kept for those that can be among the best.
            least, near = best.least(), []
            reach_of = np.linalg.norm(own, axis=1) * ROUNDING
            for p in range(0, query.size, PAIRS):
                q, v = query[p : p + PAIRS], place[p : p + PAIRS]
                scores = np.einsum("ij,ij->i", vectors[q], own[v])
                near.append(p + np.flatnonzero(scores + sizes[q] * reach_of[v] >= least[q]))
            if near:
                kept = np.concatenate(near)
                q, v = query[kept], place[kept]
                best.add(q, exact(vectors, q, own, v), ids[v])

        for batch in batches:
            for at in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(at, ROW_BLOCK)
                n = part.num_rows
                code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(n, -1)
                signs = np.unpackbits(code, axis=1, count=size).astype(np.float32) * 2 - 1
                length, along = (part.column(c).to_numpy() for c in ("length", "along"))
                own = _matrix(part.column("vector"), size)
                ids, row_ids = part.column("vec_id").to_numpy(), part.column("row_id").to_numpy()
                scale = (length / along / np.sqrt(size)).astype(np.float32)
                spread = (length * np.sqrt(np.maximum(1 - along**2, 0)) / along * (1 + 1e-3)).astype(np.float32)
                for q in range(0, len(vectors), QUERY_PART):
                    rows = slice(q, q + QUERY_PART)
                    estimate = (turned[rows] @ signs.T) * scale + from_mean[rows, None]
                    # A little more for the single precision of the estimate.
                    upper = estimate + np.outer(reach[rows], spread) + 1e-4 * (np.abs(estimate) + 1e-3)
                    upper[query_rows[rows, None] == row_ids] = -np.inf
                    # Those that the codes find best come first, so that fewer of the others are left to score.
                    head = min(k, n)
                    first = np.argpartition(-estimate, head - 1, axis=1)[:, :head]
                    ahead = np.zeros(upper.shape, dtype=bool)
                    np.put_along_axis(ahead, first, True, axis=1)
                    query, place = np.nonzero(ahead & (upper >= best.least()[rows, None]) & (upper > -np.inf))
                    score(query + q, place, own, ids)
                    query, place = np.nonzero(~ahead & (upper >= best.least()[rows, None]) & (upper > -np.inf))
                    score(query + q, place, own, ids)
        found = np.isfinite(best.score)
        made = [pa.array(np.repeat(query_rows, found.sum(axis=1))), pa.array(best.vec[found]), pa.array(best.score[found])]
        yield pa.RecordBatch.from_arrays(made, names=["query_row", "vec_id", "score"])

    return index.mapInArrow(run, "query_row long, vec_id long, score double")


def nearest(index: DataFrame, space: Space, is_query: Column, *, k: int = 20, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every index row that is a query, but that row itself.

    All candidates, if fewer than k. Of equal scores the smaller vec_id comes first. Rows that repeat are
    queries and candidates each. Without queries the result is empty.
    """
    queries = stored(index.where(is_query).select("row_id", "vec_id", "vector"), "queries")
    blocks = -(-queries.count() // block) or 1
    numbered = F.pmod(F.xxhash64("row_id"), F.lit(blocks))

    def search(i: int) -> DataFrame:
        rows = queries.where(numbered == i).select("row_id", "vector").toArrow()  # about ``block`` rows
        return _search_block(index, space, rows["row_id"].to_numpy(), _matrix(rows["vector"].combine_chunks(), space.size), k)

    found = search(0) if blocks == 1 else stored_parts(map(search, range(blocks)), "nearest")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    named = queries.select(F.col("row_id").alias("query_row"), F.col("vec_id").alias("query_id"))
    return ranked.join(named, "query_row").select("query_id", "rank", "vec_id", "score")
