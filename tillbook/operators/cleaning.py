"""Cast and clean raw text cells into typed sales rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import text
from tillbook.schema import CANONICAL_COLUMNS, CRITICAL_COLUMNS, MONEY_COLUMNS, TEXT_COLUMNS


@dataclass(frozen=True)
class CleaningOptions:
    """Choices that depend on the taste of the caller.

    ``date_formats=("yyyy-MM-dd",)`` with ``infer_dates=False`` accepts ISO
    dates only.
    """

    date_formats: tuple[str, ...] = text.DATE_FORMATS
    infer_dates: bool = True
    quantity_half_even: bool = True


def _cell(name: str) -> Column:
    return F.get("cells", F.col(f"positions.{name}"))


def add_date_mode(planned: DataFrame, raw_rows: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Extend the file plan by how its dates are written.

    ``serial_dates``: is the first non-null sale date a day number? Row number
    and answer share one bigint, so that a plain ``min`` finds the first row.
    ``date_format``: number of the format for the whole column, so that days
    and months cannot change places from cell to cell: the first that fits all
    non-null cells, else the first of those that fit most; NULL if none fits
    any. All of it is pre-aggregated before the shuffle, however many rows a
    file has. The result has one row per file.
    """
    usable = planned.filter("problem IS NULL").select("path", "positions")
    dates = raw_rows.join(usable, "path").select("path", "row_no", _cell("sale_date").alias("v"))
    # Most cells look like ISO dates, and are then held against no other pattern.
    iso, v = text.is_iso(F.col("v")), F.col("v")
    serial = F.when(~iso, text.is_serial(text.once(text.strip(v), text.to_number))).otherwise(False)
    first = F.min(F.col("row_no") * 2 + serial.cast("bigint"))
    fits = [F.when(~iso, text.parse_format(v, f)) if text.never_iso(f) else text.parse_format(v, f) for f in options.date_formats]
    fitting = [F.count(fit).alias(f"fit_{i}") for i, fit in enumerate(fits)]
    modes = dates.filter("v IS NOT NULL").groupBy("path").agg(first.alias("first"), *fitting)
    # A format that fits all cells fits most; of equal counts the first comes last in this order.
    ranked = F.array(*[F.struct(F.col(f"fit_{i}").alias("n"), F.lit(-i).alias("i")) for i in range(len(fitting))])
    best = F.array_max(ranked)
    return planned.join(modes, "path", "left").select(
        *planned.columns,
        F.coalesce(F.col("first") % 2 == 1, F.lit(False)).alias("serial_dates"),
        F.when(best["n"] > 0, -best["i"]).alias("date_format"),
    )


def standardise(raw_rows: DataFrame, planned: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """The rows of usable files with the ten canonical columns, typed; bad cells become NULL.

    ``planned`` is the file plan with its date mode. It is the only join, on
    ``path`` and without a hint: a batch has a bounded number of files,
    so Spark broadcasts the plan and no data row is shuffled; beyond the
    broadcast threshold it sorts and merges, and splits hot files.
    """
    usable = planned.filter("problem IS NULL").select("path", "positions", "serial_dates", "date_format")
    cells = raw_rows.join(usable, "path").select(
        "path", "source_file", "serial_dates", "date_format", *[_cell(c).alias(c) for c in CANONICAL_COLUMNS]
    )

    def to_date(v: Column) -> Column:
        by_number = text.once(text.once(text.strip(v), text.to_number), text.serial_to_date)
        return F.when(F.col("serial_dates"), by_number).otherwise(
            text.text_to_date(v, F.col("date_format"), options.date_formats, options.infer_dates)
        )

    # Unusual cells go through lambdas, which are not compiled: every cell is parsed once, and
    # the generated code stays small enough for the JVM to compile.
    day = text.once(F.col("sale_date"), to_date)
    if "yyyy-MM-dd" in options.date_formats:
        usual = ~F.col("serial_dates") & (F.col("date_format") == options.date_formats.index("yyyy-MM-dd")) & text.is_iso(F.col("sale_date"))
        day = F.when(usual, F.col("sale_date").try_cast("date")).otherwise(day)
    typed = {
        "sale_date": day,
        "quantity": text.round_quantity(text.to_number(F.col("quantity")), options.quantity_half_even),
        **{c: text.to_money(F.col(c)) for c in MONEY_COLUMNS},
        **{c: text.strip(F.col(c)) for c in TEXT_COLUMNS},
    }
    return cells.select(*[typed[c].alias(c) for c in CANONICAL_COLUMNS], "source_file", "path")


def clean(raw_rows: DataFrame, planned: DataFrame, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Typed rows without those that lack a critical value.

    A filter is not moved below a column that differs from run to run. Without
    one, dates and amounts would be converted in the filter, and then again.
    """
    rows = standardise(raw_rows, planned, options).withColumn("task", F.spark_partition_id())
    return rows.filter("task >= 0").dropna(subset=list(CRITICAL_COLUMNS)).drop("task")
