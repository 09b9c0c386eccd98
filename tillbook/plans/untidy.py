"""Untidy raw input derived from the star tables.

The star tables are clean, so the ingest operators get their input from them in
the spellings that real workbooks have: one file per customer with its own
header style, column order and date format, and single bad cells here and there.
Every customer and every line item takes part; the remainders below only decide
which spelling it gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schema import CANONICAL_COLUMNS, HEADER_ALIASES
from tillbook.sources.star import star_lines

# A second accepted spelling per column, for files of the third header style.
_ALTERNATIVE = {
    "sale_date": "order_date", "customer_name": "client", "city": "town", "state": "province",
    "region": "zone", "product_category": "category", "product_name": "item", "quantity": "qty",
    "price_per_unit": "rate", "sales_amount": "total",
}
assert all(v in HEADER_ALIASES[k] for k, v in _ALTERNATIVE.items())

# Conditions on the file key ``k`` and the row number ``row_no``; the text is
# valid in Spark and in DuckDB.
NO_QUANTITY = "k % 41 = 7"
EXTRA_COLUMN = "k % 4 = 1"
SECOND_AMOUNT = "k % 43 = 5"
REVERSED = "k % 2 = 1"
UNREADABLE_DATES = "k % 47 = 11"
BAD_DATE = "row_no % 29 = 0"
BAD_AMOUNT = "row_no % 19 = 0"
BAD_QUANTITY = "row_no % 23 = 0"
NO_CUSTOMER = "row_no % 31 = 0"
DATE_STYLE = "k % 5"  # 0 ISO, 1 day first, 2 month first, 3 day number, 4 with time
SERIAL_STYLE = 3


# Header that file ``k`` uses for column ``c`` (its name and an alternative): as
# it is, in capitals, another word, a letter lost, hyphenated, two letters swapped.
_LOST, _SWAP = "turn % (length(c.name) - 2)", "turn % (length(c.name) - 1)"
HEADER_SQL = f"""
  CASE WHEN {NO_QUANTITY} AND c.name = 'quantity' THEN 'zzz'
       WHEN k % 6 = 0 THEN c.name
       WHEN k % 6 = 1 THEN upper(replace(c.name, '_', ' '))
       WHEN k % 6 = 2 THEN c.other
       WHEN k % 6 = 3 THEN substr(c.name, 1, 1 + {_LOST}) || substr(c.name, 3 + {_LOST})
       WHEN k % 6 = 4 THEN '  ' || replace(c.name, '_', '-') || ' '
       ELSE substr(c.name, 1, {_SWAP}) || substr(c.name, 2 + {_SWAP}, 1)
            || substr(c.name, 1 + {_SWAP}, 1) || substr(c.name, 3 + {_SWAP}) END"""
COLUMN_PAIRS = [(c, _ALTERNATIVE[c]) for c in CANONICAL_COLUMNS]
TURN_SQL = "CAST(floor(c_custkey / 6.0) AS INT)"
SOURCE_FILE_SQL = "replace(c_name, '#', '_') || '.xlsx'"


def _in_file_order(frame: DataFrame, name: str, cells: Column, extra: Column, second: Column) -> DataFrame:
    """Add array column ``name``; a file with an odd key has its columns in reverse order."""
    none = F.array().cast("array<string>")
    straight = F.concat(
        cells,
        F.when(F.expr(EXTRA_COLUMN), F.array(extra)).otherwise(none),
        F.when(F.expr(SECOND_AMOUNT), F.array(second)).otherwise(none),
    )
    turned = F.when(F.expr(REVERSED), F.reverse(name)).otherwise(F.col(name))
    return frame.withColumn(name, straight).withColumn(name, turned)


def untidy_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, source_file, headers, error, modified_at)``: one file per customer."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(
        f"{SOURCE_FILE_SQL} AS source_file", "c_custkey AS k", f"{TURN_SQL} AS turn"
    )
    pairs = ", ".join(f"named_struct('name', '{n}', 'other', '{o}')" for n, o in COLUMN_PAIRS)
    headers = F.expr(f"transform(array({pairs}), c -> {HEADER_SQL})")
    return _in_file_order(customers, "headers", headers, F.lit("Remarks"), F.lit("Revenue")).select(
        F.concat(F.lit("inbox/"), "source_file").alias("path"),
        "source_file",
        "headers",
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("timestamp").alias("modified_at"),
    )


def _date_text() -> Column:
    day = F.col("sale_date")
    serial = F.concat(
        F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"),
        F.when(F.col("row_no") % 2 == 1, ".5").otherwise(""),
    )
    styles = [
        day.cast("string"),
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "MM/dd/yyyy"),
        serial,
        F.date_format(day, "yyyy-MM-dd 13:45:00"),
    ]
    text = styles[0]
    for i, style in enumerate(styles[1:], 1):
        text = F.when(F.expr(DATE_STYLE) == i, style).otherwise(text)
    return F.when(F.expr(UNREADABLE_DATES), "n/a").when(F.expr(BAD_DATE), "soon").otherwise(text)


def _money_text(name: str) -> Column:
    plain = F.col(name).cast("string")
    return (
        F.when(F.expr("k % 3 = 1"), F.regexp_replace(plain, r"(\d)(?=(\d{3})+\.)", "$1,"))
        .when(F.expr("k % 3 = 2"), F.concat(F.lit(" "), plain, F.lit(" ")))
        .otherwise(plain)
    )


def _padded(name: str) -> Column:
    return F.when(F.expr("k % 3 = 1"), F.concat(F.lit("\t"), name, F.lit("  "))).otherwise(F.col(name))


def untidy_rows(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """``(path, source_file, row_no, cells)``: one row per line item.

    With ``parts`` the rows are dealt by path into so many partitions, while their columns are still narrow.
    """
    lines = star_lines(spark, sf_dir).selectExpr(
        *CANONICAL_COLUMNS,
        "'inbox/' || replace(customer_name, '#', '_') || '.xlsx' AS path",
        "c_custkey AS k",
        "l_orderkey * 8 + l_linenumber AS row_no",
    )
    if parts:
        lines = lines.repartition(parts, "path")
    lines = lines.withColumn("source_file", F.substring("path", len("inbox/") + 1, 1 << 30))
    whole = F.col("quantity").cast("string")
    cells = {
        **{c: _padded(c) for c in ("city", "state", "region", "product_category", "product_name")},
        "sale_date": _date_text(),
        "customer_name": F.when(~F.expr(NO_CUSTOMER), _padded("customer_name")),
        "quantity": F.when(F.expr(BAD_QUANTITY), "1,000")
        .when(F.col("row_no") % 2 == 1, F.concat(whole, F.lit(".0")))
        .otherwise(whole),
        "price_per_unit": _money_text("price_per_unit"),
        "sales_amount": F.when(F.expr(BAD_AMOUNT), "$12").otherwise(_money_text("sales_amount")),
    }
    ordered = F.array(*[cells[c] for c in CANONICAL_COLUMNS])
    return _in_file_order(lines, "cells", ordered, F.lit("none"), F.lit("1.0")).select("path", "source_file", "row_no", "cells")
