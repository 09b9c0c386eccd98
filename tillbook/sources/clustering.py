"""Order of stored rows along a space-filling curve, so that filters on any of several columns skip row groups.

Each column is cut into ranges of about equal row counts; a row's place interleaves the bits of its ranges, the
highest first (Z-order). Rows sorted by one column after the other would serve filters on the first one only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits per column: at most 64 ranges each.
BITS = 6
_BLOCK = 8
#: Rows of a month that lie together, about: 40 MB in a shuffle.
CELL_ROWS = 500_000


def _counted(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of every column (by its number) that is not null with its count, in ranges of values, kept under ``spark.checkpoint.dir``."""
    pairs = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)])
    counted = rows.select(F.explode(pairs).alias("p")).where("p.value IS NOT NULL").groupBy("p.which", "p.value").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("which", "value").withColumn("part", F.spark_partition_id()).checkpoint()


def range_starts(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[str]]:
    """Per column the least values of its ranges, but for the first range: at most ``2 ** bits - 1`` strings.

    All columns are counted in one pass over the rows, value by value, with partial counts before the shuffle.
    Running totals come from range-partitioned parts whose sums are added up; no task sees all values of a
    column. They are kept under ``spark.checkpoint.dir`` meanwhile. A value with many rows fills several ranges, of which one is left. Nulls are in the first range.
    """
    return _starts(_counted(rows, columns), columns, bits)


def _starts(parts: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[str]]:
    """The starts of :func:`range_starts` from the counts of the values."""
    ranges = 1 << bits
    # Values meet their running total in order; the sum of a part that lies before is one row per part.
    earlier = Window.partitionBy("which").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("which", "part").agg(F.sum("n").alias("in_part"))
    totals = sums.groupBy("which").agg(F.sum("in_part").alias("total"))
    sums = sums.select("which", "part", F.coalesce(F.sum("in_part").over(earlier), F.lit(0)).alias("before"))
    within = F.sum("n").over(Window.partitionBy("which", "part").orderBy("value")) - F.col("n")
    placed = parts.withColumn("within", within).join(sums, ["which", "part"]).join(totals, "which")
    number = F.floor((F.col("before") + F.col("within")) * ranges / F.col("total"))
    starts = placed.groupBy("which", number.alias("range")).agg(F.min("value").alias("start")).where("range > 0")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in starts.orderBy("which", "range").collect():  # 2 ** bits per column at most
        out[columns[r["which"]]].append(r["start"])
    return out


def curve_place(starts: dict[str, list[str]], bits: int = BITS) -> Column:
    """Place of a row on the curve, a bigint; the ranges of the columns are those of :func:`range_starts`."""
    if bits * len(starts) > 63:
        raise ValueError(f"{len(starts)} columns of {bits} bits do not fit into one number")
    place = F.lit(0).cast("bigint")
    for i, (name, values) in enumerate(starts.items()):
        spread = [sum((n >> bit & 1) << bit * len(starts) + len(starts) - 1 - i for bit in range(bits)) for n in range(len(values) + 1)]
        place = place.bitwiseOR(F.get(F.array(*[F.lit(n).cast("bigint") for n in spread]), _range_of(F.col(name).cast("string"), values)))
    return place


def _range_of(value: Column, starts: list[str]) -> Column:
    """Number of the range of a value: how many of the starts it reaches; 0 for null.

    Found among every eighth start first, then among the seven that follow: comparing a row with all of them took longer than reading it.
    """

    def reached(known: Column) -> Column:
        return F.size(F.filter(known, lambda v: v <= value))

    def strings(values: list[str]) -> Column:
        return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")

    block = reached(strings(starts[_BLOCK - 1 :: _BLOCK]))
    blocks = F.array(*[strings(starts[at : at + _BLOCK - 1]) for at in range(0, len(starts) + 1, _BLOCK)])
    return F.when(value.isNull(), 0).otherwise(block * _BLOCK + reached(F.get(blocks, block)))


def along_curve(rows: DataFrame, columns: Sequence[str], month: str = "sale_month", cell_rows: int = CELL_ROWS) -> DataFrame:
    """The rows dealt by month and stretch of the curve, and sorted by month and place on it.

    The curve is cut into stretches by the first bits of a place, as many as the largest month has times ``cell_rows`` rows, so
    into one for months of usual size. Dealing by ranges instead would make all rows once more, to find where tasks begin. Adaptive execution
    puts small stretches together and splits large ones, repeated rows among them.
    """
    counts = _counted(rows, [*columns, month])
    starts = _starts(counts.where(F.col("which") < len(columns)), columns, BITS)
    largest = counts.where(F.col("which") == len(columns)).agg(F.max("n")).first()[0] or 0
    # Bits that no range of a column has are none by which its stretches differ.
    used = sorted((bit * len(columns) + len(columns) - 1 - i for i, c in enumerate(columns) for bit in range(len(starts[c]).bit_length())), reverse=True)
    cuts = used[: math.ceil(math.log2(max(1, largest / cell_rows)))]
    stretch = F.shiftright("place", cuts[-1]) if cuts else F.lit(0)
    placed = rows.withColumn("place", curve_place(starts)).withColumn("stretch", stretch)
    return placed.hint("rebalance", month, "stretch").sortWithinPartitions(month, "place").drop("place", "stretch")
