"""Sales rows from a TPC-H-like star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.schema import SALES_COLUMNS


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a sales row, plus its keys.

    Customers are joined to the orders first, so that the line items, the largest
    side, are shuffled for the order key and the part key only. The names of their
    places come last: until then a line carries a nation's key. No side is
    broadcast by hint: Spark decides from measured sizes.
    """

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    customers = table("customer").select("c_custkey", "c_name", "c_nationkey")
    sold = table("orders").join(customers, F.expr("o_custkey = c_custkey"))
    lines = (
        table("lineitem")
        .join(sold, F.expr("l_orderkey = o_orderkey"))
        .join(table("part"), F.expr("l_partkey = p_partkey"))
        .join(table("nation"), F.expr("c_nationkey = n_nationkey"))
        .join(table("region"), F.expr("n_regionkey = r_regionkey"))
    )
    return lines.select(
        F.expr("CAST(o_orderdate AS DATE)").alias("sale_date"),
        F.col("c_name").alias("customer_name"),
        F.expr("CASE WHEN c_custkey % 97 <> 0 THEN n_name || '_C' || CAST(c_custkey % 4 AS STRING) END").alias("city"),
        F.col("n_name").alias("state"),
        F.expr("CASE WHEN c_custkey % 89 <> 0 THEN r_name END").alias("region"),
        F.col("p_type").alias("product_category"),
        F.col("p_name").alias("product_name"),
        F.expr("CAST(l_quantity AS INT)").alias("quantity"),
        F.col("p_retailprice").alias("price_per_unit"),
        F.expr("l_extendedprice * (1 - l_discount)").alias("sales_amount"),
        F.expr("'sales_' || CAST(year(o_orderdate) AS STRING) || '.xlsx'").alias("source_file"),
        F.expr("CAST(l_shipdate AS TIMESTAMP)").alias("loaded_at"),
        "l_orderkey",
        "l_linenumber",
        "c_custkey",
    )


def star_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales columns of :func:`star_lines`."""
    return star_lines(spark, sf_dir).select(*SALES_COLUMNS)
