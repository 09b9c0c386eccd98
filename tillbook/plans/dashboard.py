"""The seven dashboard queries.

Queries with a limit sort in the same step, with ties broken by all keys, so
that Spark keeps only the leading rows of each partition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.plans.views import VIEWS, down, register_views, up
from tillbook.streaming.ingest import SalesStore

TOP_PRODUCTS, TOP_CUSTOMERS = 15, 20


def kpis(rows: DataFrame) -> DataFrame:
    """Six key figures; zeros for an empty table."""
    return rows.select(
        "total_revenue", "total_transactions", "unique_customers",
        "total_units_sold", "avg_order_value", "files_processed",
    ).limit(1)


def daily_sales(rows: DataFrame) -> DataFrame:
    """Revenue and number of sales per day, oldest first."""
    return rows.orderBy(up("sale_date")).select(
        F.col("sale_date").cast("string").alias("sale_date"), "total_revenue", "transaction_count"
    )


def regional(rows: DataFrame) -> DataFrame:
    """One row per region and state, without the state."""
    return rows.orderBy(down("total_revenue")).select("region", "total_revenue", "total_orders", "unique_customers")


def category(rows: DataFrame) -> DataFrame:
    """Revenue and units per category, highest revenue first."""
    return rows.orderBy(down("total_revenue")).select("product_category", "total_revenue", "total_units")


def top_products(rows: DataFrame) -> DataFrame:
    """The products with the highest revenue."""
    return (
        rows.select("product_name", "product_category", "total_revenue", "total_units_sold", "avg_price")
        .orderBy(down("total_revenue"), up("product_name"), up("product_category"))
        .limit(TOP_PRODUCTS)
    )


def top_customers(rows: DataFrame) -> DataFrame:
    """The customers who spent most."""
    return (
        rows.select("customer_name", "city", "state", "region", "total_orders", "total_spent", "avg_order_value")
        .orderBy(down("total_spent"), up("customer_name"), up("city"), up("state"), up("region"))
        .limit(TOP_CUSTOMERS)
    )


def file_statistics(rows: DataFrame) -> DataFrame:
    """Rows and revenue per source file, latest first."""
    return rows.orderBy(down("first_loaded_at")).select(
        "source_file",
        "records_loaded",
        F.col("first_loaded_at").cast("string").alias("first_loaded_at"),
        "total_revenue",
    )


Panel = Callable[[DataFrame], DataFrame]

#: The view of each panel, and the panel made from the view's rows.
SHAPES: dict[str, tuple[str, Panel]] = {
    "kpis": ("v_kpi_summary", kpis),
    "daily_sales": ("v_daily_sales", daily_sales),
    "regional": ("v_regional_performance", regional),
    "category": ("v_category_summary", category),
    "top_products": ("v_product_performance", top_products),
    "top_customers": ("v_top_customers", top_customers),
    "file_statistics": ("v_pipeline_stats", file_statistics),
}


def _over_sales(view: str, panel: Panel) -> Panel:
    return lambda sales: panel(VIEWS[view].rows(sales))


PANELS: dict[str, Panel] = {name: _over_sales(*shape) for name, shape in SHAPES.items()}


def refresh(spark: SparkSession, store: SalesStore) -> dict[str, DataFrame]:
    """All panels and SQL views on the table as it is now, from all its rows.

    The table is listed anew, so batches written since the last refresh are
    included. Nothing is cached: each panel reads only the columns it needs,
    which at scale is far less than a cache of the table would hold.
    """
    sales = store.sales(spark)
    register_views(spark, sales)
    return {name: panel(sales) for name, panel in PANELS.items()}
