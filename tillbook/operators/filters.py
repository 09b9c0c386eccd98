"""Row filters over the sales table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_sales(
    sales: DataFrame,
    date_from: date | None = None,
    date_to: date | None = None,
    regions: list[str] | None = None,
    cities: list[str] | None = None,
    categories: list[str] | None = None,
    customers: list[str] | None = None,
    source_files: list[str] | None = None,
    loaded_from: datetime | None = None,
    loaded_to: datetime | None = None,
) -> DataFrame:
    """Keep rows within the given bounds (inclusive) and value lists.

    All conditions reach the Parquet scan. A date bound is repeated on
    ``sale_month`` where the table has it, which skips whole partitions.
    """
    by_month = "sale_month" in sales.columns
    out = sales
    if date_from is not None:
        out = out.filter(F.col("sale_date") >= F.lit(date_from))
        if by_month:
            out = out.filter(F.col("sale_month") >= F.lit(date_from.isoformat()[:7]))
    if date_to is not None:
        out = out.filter(F.col("sale_date") <= F.lit(date_to))
        if by_month:
            out = out.filter(F.col("sale_month") <= F.lit(date_to.isoformat()[:7]))
    if loaded_from is not None:
        out = out.filter(F.col("loaded_at") >= F.lit(loaded_from))
    if loaded_to is not None:
        out = out.filter(F.col("loaded_at") <= F.lit(loaded_to))
    wanted = {
        "region": regions,
        "city": cities,
        "product_category": categories,
        "customer_name": customers,
        "source_file": source_files,
    }
    for name, values in wanted.items():
        if values is not None:
            out = out.filter(F.col(name).isin(values))
    return out
