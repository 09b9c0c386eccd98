"""Near-duplicate documents: weighted MinHash signatures, bands, and verified multiset overlap.

1. One pass gives every row the bag of its five-word shingles (a 16-byte id) and, per distinct bag, a
   signature of 192 slots. Rows with one bag are one node from here on, named by a number.
2. Nodes that agree in all six slots of one of 32 bands share a bucket. Every node is paired with the
   least node of each of its buckets; pairs whose signatures agree too little are left, the others are
   verified on their bags. Verified links form components.
3. Buckets with nodes of several components are gone through again: their nodes are brought together by
   the largest of these components, and all pairs from different components are compared, first by
   signature, then by bag. What is already connected is not compared. Large sets are split into blocks
   that meet two by two, so that no group holds more than two blocks; a set has as many blocks as its
   nodes or its shingles ask for, dealt by hash.

A pair of similarity 0.8 shares no bucket with a probability of 6e-5.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.llm.bagminhash import BANDS, ROWS, SLOTS, bags_of, overlap, signatures
from tillbook.llm.common import Words, fields, map_text, prepare, stored
from tillbook.llm.components import components

SIMILAR = 0.8
#: Four standard deviations of the estimate at 0.8: a similar pair falls below with a probability of 3e-5.
LEAST_ESTIMATE = SIMILAR - 4 * (SIMILAR * (1 - SIMILAR) / SLOTS) ** 0.5
#: Nodes of a block of step 3, and distinct shingles (16 bytes each); a longer text is in a block as a whole.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 20
#: Keys (8 bytes each) that are broadcast at most; more are joined by a shuffle.
BROADCAST_KEYS = 2_000_000


def text_key() -> Column:
    """The key by which one text of a node is found again; texts may share it."""
    return F.xxhash64("text")


def few_keys(keys: DataFrame) -> DataFrame:
    """The stored keys, marked for broadcast only if they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def signed_rows(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """row (struct of ``keep``), row_id, text_key, bag, its distinct shingles and signature of every row, stored."""

    def start():
        def step(texts: pa.Array) -> list[pa.Array]:
            bags = bags_of(Words(texts))
            ids = bags.ids()
            signed = signatures(bags)
            return [
                pa.array(ids, pa.binary()),
                pa.array(np.diff(bags.first), pa.int64()),
                pa.array([s.tobytes() if i else None for s, i in zip(signed, ids, strict=True)], pa.binary()),
            ]

        return step

    row = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("text_key", text_key())
    signed = map_text(rows, "text", ["row", "text_key"], fields(bag="binary", size="long", signature="binary"), start)
    return stored(signed.withColumn("row_id", F.monotonically_increasing_id()), "signed")


def nodes_of(rows: DataFrame) -> DataFrame:
    """The distinct bags of the signed rows, numbered, stored."""
    nodes = rows.where("bag IS NOT NULL").groupBy("bag")
    nodes = nodes.agg(F.first("signature").alias("signature"), F.min("text_key").alias("text_key"), F.first("size").alias("size"))
    return stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def bags_for(docs: DataFrame, text: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, shingles and counts of the wanted nodes, made again from one text of each, stored.

    Texts that share a key by chance are told apart by a second hash and by their bags.
    """
    keys = nodes.join(wanted, "node", "left_semi").select(F.col("text_key").alias("key"), "node", "bag")
    keys = few_keys(stored(keys, "keys"))
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"))
    texts = texts.withColumns({"key": text_key(), "second": F.xxhash64(F.lit(1), "text")}).join(keys, "key")
    texts = texts.groupBy("key", "second", "node").agg(F.first("text").alias("text"), F.first("bag").alias("bag"))

    def start():
        def step(texts: pa.Array) -> list[pa.Array]:
            bags = bags_of(Words(texts))
            offsets = pa.array(bags.first.astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int64))) for x in (bags.shingles.view(np.int64), bags.counts)]
            return [pa.array(bags.ids(), pa.binary()), *lists]

        return step

    made = map_text(texts, "text", ["node", "bag"], fields(made="binary", shingles="longs", counts="longs"), start)
    return stored(made.where("made = bag").select("node", "shingles", "counts"), "bags")


def _agreement(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree in enough slots."""
    prepare(pairs.sparkSession)
    one = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SLOTS) for c in ("sa", "sb")]
            enough = (sides[0] == sides[1]).mean(axis=1) >= LEAST_ESTIMATE
            yield pa.RecordBatch.from_pandas(batch.select(["a", "b"]).to_pandas()[enough], schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]), preserve_index=False)

    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """Pairs (a, b) whose bags are similar."""
    prepare(pairs.sparkSession)
    left = bags.select(F.col("node").alias("a"), F.col("shingles").alias("xs"), F.col("counts").alias("xn"))
    right = bags.select(F.col("node").alias("b"), F.col("shingles").alias("ys"), F.col("counts").alias("yn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.asarray(x.values) for x in batch.column(c)] for c in ("xs", "xn", "ys", "yn")]
            rows = []
            for i, (xs, xn, ys, yn) in enumerate(zip(*sides, strict=True)):
                both, either = overlap((xs.view(np.uint64), xn), (ys.view(np.uint64), yn))
                if both >= SIMILAR * either:
                    rows.append(i)
            yield batch.select(["a", "b"]).take(pa.array(rows, pa.int64()))

    joined = pairs.join(left, "a").join(right, "b")
    return joined.select("a", "b", "xs", "xn", "ys", "yn").mapInArrow(run, "a long, b long")


def _links_across(group: pd.DataFrame) -> pd.DataFrame:
    """Links that connect different components among the nodes of one or two blocks."""
    roots = {r: r for r in group["root"]}

    def find(x: int) -> int:
        while roots[x] != x:
            roots[x] = roots[roots[x]]
            x = roots[x]
        return x

    n = len(group)
    nodes, root = group["node"].to_numpy(), pd.factorize(group["root"])[0]
    names, block = group["root"].to_numpy(), group["block"].to_numpy()
    bags = [(np.asarray(s).view(np.uint64), np.asarray(c)) for s, c in zip(group["shingles"], group["counts"], strict=True)]
    weight = np.array([c.sum() for _, c in bags])
    signed = np.frombuffer(b"".join(group["signature"]), np.uint16).reshape(n, SLOTS)
    across = group["first_block"].iloc[0] != group["second_block"].iloc[0]
    out = []
    for i in range(n):
        rest = np.flatnonzero((root[i + 1 :] != root[i]) & ((block[i + 1 :] != block[i]) if across else True)) + i + 1
        light, heavy = np.minimum(weight[rest], weight[i]), np.maximum(weight[rest], weight[i])
        rest = rest[light >= SIMILAR * heavy]
        agree = (signed[rest] == signed[i]).mean(axis=1)
        for j in rest[np.argsort(-agree)][: int((agree >= LEAST_ESTIMATE).sum())]:
            if find(names[i]) == find(names[j]):
                continue
            both, either = overlap(bags[i], bags[j])
            if both >= SIMILAR * either:
                roots[find(names[i])] = find(names[j])
                out.append((nodes[i], nodes[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _remaining_links(docs: DataFrame, text: str, buckets: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Step 3: links between components that share a bucket."""
    rooted = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per_root = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = per_root.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("n", "root"))["root"].alias("head"))
    mixed = mixed.where("k > 1").select("bucket", "head")
    sets = stored(rooted.join(mixed, "bucket").select("head", "node", "root").distinct(), "sets")
    bags = bags_for(docs, text, nodes, sets.select("node").distinct())
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    sizes = sets.join(nodes.select("node", "size"), "node").groupBy("head").agg(blocks.alias("blocks"))
    placed = sets.join(sizes, "head").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = placed.select("head", "node", "root", "block", other)
    met = met.withColumns({"first_block": F.least("block", "other"), "second_block": F.greatest("block", "other")})
    full = met.join(nodes.select("node", "signature"), "node").join(bags, "node")
    columns = ["head", "first_block", "second_block", "block", "node", "root", "signature", "shingles", "counts"]
    return full.select(*columns).groupBy("head", "first_block", "second_block").applyInPandas(_links_across, "a long, b long")


def near_duplicate_links(docs: DataFrame, text: str, nodes: DataFrame) -> DataFrame:
    """Verified links (a, b) between nodes that connect all near duplicates, stored."""
    width = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("signature", b * width + 1, F.lit(width)))
    )
    banded = nodes.select("node", F.explode(keys).alias("bucket"))
    heads = banded.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head <> last")
    buckets = stored(banded.join(heads.select("bucket", "head"), "bucket"), "buckets")
    stars = buckets.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    close = stored(_agreement(stars, nodes), "close")
    ends = close.select(F.col("a").alias("node")).union(close.select(F.col("b").alias("node"))).distinct()
    links = stored(_similar(close, bags_for(docs, text, nodes, ends)), "links")
    rest = _remaining_links(docs, text, buckets.select("bucket", "node"), nodes, stored(components(links), "roots"))
    return stored(links.union(rest), "links")


def near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all but the text), class_id, class_size and kept, per row.

    A class holds the rows that are connected by similarities of 0.8 or more between bags of five-word
    shingles (weighted Jaccard); equal bags belong together. class_id is its least document id and the row
    with that id is kept, of several the first one; a null id comes last. A text without words is a class
    of its own, named by its id. A text of fewer than five words is one shingle. Input columns named like
    a result give way to it.
    """
    new = ("class_id", "class_size", "kept")
    keep = [c for c in ([c for c in docs.columns if c != text] if keep is None else keep) if c.lower() not in new]
    rows, classes = _classified(docs, doc, text, keep)
    return rows.join(classes, "bag", "left").select(
        *[F.col("row").getField("keep").getField(c).alias(c) for c in keep],
        F.coalesce("class_id", F.col("row.id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        (F.col("kept_row").isNull() | (F.col("kept_row") == F.col("row_id"))).alias("kept"),
    )


def _classified(docs: DataFrame, doc: str, text: str, keep: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The signed rows, and class_id, class_size and kept_row of every bag."""
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(0).alias("none"))
    inner = docs.select(F.col(f"`{doc}`").alias("id"), kept.alias("keep"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = signed_rows(inner, "text", ["id", "keep"])
    nodes = nodes_of(rows)
    roots = stored(components(near_duplicate_links(inner, "text", nodes)), "roots")
    named = nodes.select("bag", "node").join(roots, "node", "left").select("bag", F.coalesce("root", "node").alias("root"))
    first = F.min(F.struct(F.col("row.id").isNull(), F.col("row.id").alias("id"), "row_id")).alias("first")
    per_bag = rows.where("bag IS NOT NULL").groupBy("bag").agg(first, F.count(F.lit(1)).alias("n"))
    per_bag = stored(per_bag.join(named, "bag"), "bag-roots")
    per_class = per_bag.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("class_size"))
    classes = per_bag.select("bag", "root").join(per_class, "root").select(
        "bag", F.col("first.id").alias("class_id"), "class_size", F.col("first.row_id").alias("kept_row")
    )
    return rows, stored(classes, "classes")


def drop_near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns."""
    rows, classes = _classified(docs, doc, text, docs.columns)
    gone = rows.join(classes.where("class_size > 1"), "bag").where("row_id <> kept_row")
    gone = few_keys(stored(gone.select("row_id"), "gone"))
    return rows.join(gone, "row_id", "left_anti").select("row.keep.*")
