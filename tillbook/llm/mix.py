"""Mixing sources to target weights by capped water-filling.

The words of the mix are a share of all words. They are dealt to the sources in proportion to their
weights; a source whose part would exceed its maximum of epochs is clamped there, and what is left over is
dealt again among the others, until no part exceeds. A source is then taken as often as its target holds
it whole, and a seeded part of it once more: its documents in the order of a hash, up to the target, the
last one in part. The place where a target is met is found by sums of hash slices, then by running totals of
the keys within one slice, which are sorted into parts by range. No source, slice or set of equal rows is gathered in one
task, and no text is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.llm.common import stored

SHARE = 1.5
MAX_EPOCHS = 2.0
CYCLE = (3.0, 1.0, 2.0)
SEED = "mix-1"
#: Hash slices of a source: the first hexadecimal digits.
SLICE_DIGITS = 3


def words_in(text: str) -> Column:
    """Runs of anything but white space in ASCII; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_sizes(sized: DataFrame) -> DataFrame:
    """source, source_size of every source; null is a source of its own."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"))


def cycle_weights(sources: DataFrame, cycle: Sequence[float] = CYCLE) -> DataFrame:
    """weight of each source: the cycle's values in the order of the names by code point, null last.

    Ranks come from range-partitioned parts, whose counts are added up; no task sees all sources.
    """
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = stored(ordered, "sources")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    place = ((F.col("row") - 1 + F.col("offset")) % len(cycle) + 1).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), place)
    return parts.withColumn("row", within).join(offsets, "part").select("source", "source_size", weight.alias("weight"))


def water_fill(weighted: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """target of each source: its weighted part of ``share`` of all sizes, at most ``max_epochs`` of its own.

    Each round clamps the sources whose part exceeds their maximum and deals the rest again. A source of
    weight 0 or null gets nothing, and neither does one without words.
    """
    rows = weighted.withColumns({
        "weight": F.coalesce(F.col("weight"), F.lit(0.0)),
        "cap": F.col("source_size") * F.lit(float(max_epochs)),
    })
    budget = float(rows.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        # The level only rises: what it clamps, stays clamped.
        clamped = F.col("weight") * F.lit(level) > F.col("cap")
        used = F.sum(F.when(clamped, F.col("cap")).otherwise(0.0))
        free = F.sum(F.when(clamped, 0.0).otherwise(F.col("weight")))
        used, free = rows.agg(used, free).first()
        if not free:
            break
        now = (budget - used) / free
        if now <= level:
            break
        level = now
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return rows.withColumn("target", target).drop("cap")


def _parts(frame: DataFrame, value: str, what: str) -> DataFrame:
    """The frame stored, with ``before``: the sum of ``value`` over its source in all earlier parts; ``part`` names the part."""
    parts = stored(frame.withColumn("part", F.spark_partition_id()), what)
    earlier = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sums = parts.groupBy("of", "part").agg(F.sum(value).alias("n"))
    sums = sums.select(F.col("of").alias("whose"), F.col("part").alias("earlier_than"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    met = (F.col("part") == F.col("earlier_than")) & F.col("of").eqNullSafe(F.col("whose"))
    return parts.join(sums, met).drop("earlier_than", "whose")


def _met(sums: DataFrame, upto: Column, targets: DataFrame, left: str) -> DataFrame:
    """The row of each source in which ``left`` of it is met, with ``open``: what is left when the row begins."""
    found = sums.withColumn("upto", upto).join(targets, F.col("of").eqNullSafe(F.col("source")))
    found = found.where((F.col("upto") > F.col(left)) & (F.col("upto") - F.col("size") <= F.col(left)))
    return found.withColumn("open", F.col(left) - F.col("upto") + F.col("size"))


def mix(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] | None = None,
    weights: DataFrame | None = None,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Columns ``keep`` (default: all), size (words), source_size, target and taken (words the mix takes).

    ``weights`` (source, weight) gives the weights; without it they cycle through ``CYCLE`` by name. Equal
    seeds give equal mixes. The words taken from a source are its target, rounded down; a document gives
    at most one more than the whole number of epochs. Rows that repeat are taken one by one; documents of
    one id are ordered by size and text. A null text has no words; a null source is a source; a null id is
    the empty string. Rows alike in id and text, where the target falls among them, are taken one after the
    other, in no stated order. Input columns named like a result give way to it.
    """
    new = ("size", "source_size", "target", "taken")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit(""))))
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row") if keep else F.struct(F.lit(0).alias("none")).alias("row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        words_in(text).alias("size"),
        order.alias("order"),
        F.substring(order, 1, SLICE_DIGITS).alias("slice"),
        body.alias("text"),
    )
    # Made of the rows of one slice only, so above the joins that choose them.
    key = F.struct("order", words_in("text").alias("size"), F.md5("text").alias("text"), F.col("text").isNull().alias("none"))
    slices = stored(rows.groupBy("source", "slice").agg(F.sum("size").alias("size")), "slices")
    sources = source_sizes(slices)
    if weights is None:
        weighted = cycle_weights(sources)
    else:
        given = weights.select(F.col("source").cast("string").alias("named"), F.col("weight").cast("double").alias("weight"))
        given = given.groupBy("named").agg(F.max("weight").alias("weight"))
        weighted = sources.join(given, F.col("source").eqNullSafe(F.col("named")), "left").drop("named")
    targets = water_fill(stored(weighted, "weights"), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("long"))
    targets = targets.withColumn("rest", F.floor("target").cast("long") - F.col("whole") * F.col("source_size"))
    # The slice in which the rest of a source is met, and in it the key.
    named = slices.select(F.col("source").alias("of"), "slice", "size")
    cuts = _met(named, F.sum("size").over(Window.partitionBy("of").orderBy("slice")), targets, "rest")
    cuts = stored(cuts.select("source", F.col("slice").alias("cut"), "open"), "cuts")
    inside = rows.select(F.col("source").alias("of"), "slice", "order", "text").join(
        cuts.select("source", "cut"), F.col("of").eqNullSafe(F.col("source")) & (F.col("slice") == F.col("cut"))
    )
    keys = inside.select("of", key.alias("key")).select("of", "key", F.col("key.size").alias("size")).groupBy("of", "key").agg(F.sum("size").alias("size"))
    keys = _parts(keys.orderBy("of", "key"), "size", "keys")
    within = F.sum("size").over(Window.partitionBy("part", "of").orderBy("key"))
    edges = _met(keys, F.col("before") + within, cuts, "open")
    edges = edges.select("of", "cut", F.col("key").alias("edge"), "open")
    plan = targets.join(edges, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "whole", "cut", "edge", "open"
    )
    dealt = rows.join(stored(plan, "targets"), F.col("source").eqNullSafe(F.col("of")))
    # A source that is taken in whole epochs, or has no words, has no edge.
    inside_key = F.when(F.col("slice") == F.col("cut"), key)
    at_edge = (F.col("slice") == F.col("cut")) & (inside_key == F.col("edge"))
    below = (F.col("slice") < F.col("cut")) | (inside_key < F.col("edge"))
    sure = dealt.where(~F.coalesce(at_edge, F.lit(False))).withColumn("taken", F.col("size") * (F.col("whole") + F.when(below, 1).otherwise(0)))
    close = dealt.where(at_edge).select("of", "row", "size", "source_size", "target", "whole", "open")
    close = _parts(close.withColumns({"at": F.monotonically_increasing_id(), "one": F.lit(1)}), "one", "edges")
    number = F.col("before") + F.row_number().over(Window.partitionBy("part", "of").orderBy("at")) - 1
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("open") - number * F.col("size")))
    close = close.withColumn("taken", F.col("size") * F.col("whole") + more)
    both = sure.select("row", *new).unionByName(close.select("row", *new))
    return both.select(*[F.col("row").getField(c).alias(c) for c in keep], *new)
