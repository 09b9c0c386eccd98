"""Whether rows come in the order they are promised in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _before(name: str, previous: Column, current: Column) -> tuple[Column, Column]:
    """Whether a pair is in order by one key ("-name": descending, NULL first; else ascending, NULL last), and whether it ties."""
    key = name.removeprefix("-")
    p, c = previous[key], current[key]
    first, second = (p, c) if name.startswith("-") else (c, p)
    # Descending: NULL, then large values. Ascending is the same, read from the end.
    ahead = F.coalesce(first > second, F.lit(False)) | (first.isNull() & second.isNotNull())
    return ahead, p.eqNullSafe(c)


def _out_of_order(order: tuple[str, ...], previous: Column, current: Column) -> Column:
    fits, ties = F.lit(False), F.lit(True)
    for name in order:
        ahead, same = _before(name, previous, current)
        fits, ties = fits | (ties & ahead), ties & same
    return ~(fits | ties)


def disorder(rows: DataFrame, order: tuple[str, ...], name: str) -> DataFrame:
    """One row: name, n_rows and n_out_of_order, the neighbours in ``rows`` that stand the wrong way round.

    Neighbours within a partition are compared there; those across partitions by the first and last row of each.
    """
    keys = F.struct(*[F.col(c.removeprefix("-")) for c in order]).alias("row")
    placed = rows.select(keys, F.monotonically_increasing_id().alias("place"), F.spark_partition_id().alias("part"))
    inner = Window.partitionBy("part").orderBy("place")
    pairs = placed.withColumn("previous", F.lag("row").over(inner))
    wrong = (F.col("previous").isNotNull() & _out_of_order(order, F.col("previous"), F.col("row"))).cast("long")
    parts = pairs.groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(wrong).alias("wrong"), F.min_by("row", "place").alias("first"), F.max_by("row", "place").alias("last")
    )
    # One row per partition.
    across = parts.withColumn("previous", F.lag("last").over(Window.orderBy("part")))
    broken = (F.col("previous").isNotNull() & _out_of_order(order, F.col("previous"), F.col("first"))).cast("long")
    return across.agg(
        F.lit(name).alias("name"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("wrong") + broken), F.lit(0)).alias("n_out_of_order")
    )


def disorders(named: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """:func:`disorder` of several results."""
    return reduce(DataFrame.unionByName, [disorder(rows, order, name) for name, (rows, order) in named.items()])
