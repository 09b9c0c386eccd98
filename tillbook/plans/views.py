"""The sixteen reporting views over the sales table.

A view is declared by its keys, its measures and its order; all of them are one
filter, one grouped aggregation and one sort. Every measure is pre-aggregated
before the shuffle, so a key that holds a large part of all rows is no burden.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.money import money_2dp, money_avg, money_sum, share_pct, unit_sum, units_2dp

Measure = Callable[[], Column]

AMOUNT, PRICE, QUANTITY = "sales_amount", "price_per_unit", "quantity"


def _rows() -> Column:
    return F.count(F.lit(1))


def _quantity() -> Column:
    return F.sum(QUANTITY)


def _revenue() -> Column:
    return money_sum(F.col(AMOUNT))


def _avg_order() -> Column:
    return money_avg(F.col(AMOUNT))


def _avg_price() -> Column:
    return money_avg(F.col(PRICE))


def _customers() -> Column:
    return F.countDistinct("customer_name")


def down(name: str) -> Column:
    """Descending with NULL first, as the views promise."""
    return F.col(name).desc_nulls_first()


def up(name: str) -> Column:
    """Ascending with NULL last."""
    return F.col(name).asc_nulls_last()


@dataclass(frozen=True)
class View:
    """Keys, measures and order of one view."""

    keys: tuple[str, ...]
    measures: dict[str, Measure]
    order: tuple[str, ...] = ()  # "-name" sorts descending
    not_null: tuple[str, ...] = ()
    by_month: bool = False
    share: str | None = None

    def rows(self, sales: DataFrame) -> DataFrame:
        """The rows of the view in no particular order."""
        source = sales
        for name in self.not_null:
            source = source.filter(F.col(name).isNotNull())
        if self.by_month:
            # Group by the first day of the month and format once per group.
            source = source.withColumn("month", F.trunc("sale_date", "month"))
        aggregates = [m().alias(n) for n, m in self.measures.items()]
        if self.share:
            aggregates.append(unit_sum(F.col(AMOUNT)).alias("_units"))
        out = source.groupBy(*self.keys).agg(*aggregates)
        if self.by_month:
            out = out.withColumn("month", F.date_format("month", "yyyy-MM"))
        if self.share:
            # A scalar subquery over the one column it needs, instead of a
            # window over all groups, which would run in a single task.
            total = source.agg(unit_sum(F.col(AMOUNT)).alias("total")).scalar()
            out = out.withColumn(self.share, share_pct(F.col("_units"), total))
        return out.select(*self.keys, *self.measures, *([self.share] if self.share else []))

    def __call__(self, sales: DataFrame) -> DataFrame:
        order = [down(c[1:]) if c.startswith("-") else up(c) for c in self.order]
        return self.rows(sales).orderBy(*order)


class KpiSummary(View):
    """One row of key figures, also for an empty table.

    Each distinct count is a subquery of its own that reads a single column.
    Together in one aggregation they would make Spark copy every row four times.
    """

    def rows(self, sales: DataFrame) -> DataFrame:
        def distinct(name: str) -> Column:
            return sales.agg(F.countDistinct(name).alias("n")).scalar()

        figures = sales.agg(
            unit_sum(F.col(AMOUNT)).alias("units"),
            _rows().alias("total_transactions"),
            _quantity().alias("quantity"),
            _avg_order().alias("average"),
            F.min("sale_date").alias("earliest_sale"),
            F.max("sale_date").alias("latest_sale"),
            F.max("loaded_at").alias("last_loaded"),
        )
        zero = F.lit(0).cast("decimal(38,2)")
        return figures.select(
            F.coalesce(units_2dp(F.col("units")), zero).alias("total_revenue"),
            "total_transactions",
            F.coalesce(distinct("customer_name"), F.lit(0)).alias("unique_customers"),
            F.coalesce("quantity", F.lit(0)).alias("total_units_sold"),
            F.coalesce("average", zero).alias("avg_order_value"),
            F.coalesce(distinct("source_file"), F.lit(0)).alias("files_processed"),
            F.coalesce(distinct("product_name"), F.lit(0)).alias("unique_products"),
            "earliest_sale",
            "latest_sale",
            "last_loaded",
        )

    def __call__(self, sales: DataFrame) -> DataFrame:
        return self.rows(sales)


def _of(function: Callable[[str], Column], name: str) -> Measure:
    return lambda: function(name)


VIEWS: dict[str, View] = {
    "v_kpi_summary": KpiSummary(keys=(), measures={}),
    "v_daily_sales": View(
        keys=("sale_date",),
        measures={
            "transaction_count": _rows,
            "total_quantity": _quantity,
            "total_revenue": _revenue,
            "calculated_revenue": lambda: money_sum(F.col(QUANTITY) * F.col(PRICE)),
            "avg_order_value": _avg_order,
        },
        not_null=("sale_date",),
        order=("sale_date",),
    ),
    "v_monthly_kpis": View(
        keys=("month",),
        measures={
            "total_orders": _rows,
            "total_items_sold": _quantity,
            "total_revenue": _revenue,
            "average_order_value": _avg_order,
        },
        not_null=("sale_date",),
        by_month=True,
        order=("-month",),
    ),
    "v_regional_performance": View(
        keys=("region", "state"),
        measures={
            "unique_customers": _customers,
            "total_orders": _rows,
            "total_quantity": _quantity,
            "total_revenue": _revenue,
            "avg_order_value": _avg_order,
        },
        share="revenue_share_pct",
        order=("-total_revenue",),
    ),
    "v_city_performance": View(
        keys=("city", "state", "region"),
        measures={
            "unique_customers": _customers,
            "total_orders": _rows,
            "total_quantity": _quantity,
            "total_revenue": _revenue,
            "avg_order_value": _avg_order,
        },
        order=("-total_revenue",),
    ),
    "v_category_summary": View(
        keys=("product_category",),
        measures={
            "product_count": _of(F.countDistinct, "product_name"),
            "total_orders": _rows,
            "total_units": _quantity,
            "total_revenue": _revenue,
            "avg_order_value": _avg_order,
            "min_price": lambda: money_2dp(F.min(PRICE)),
            "max_price": lambda: money_2dp(F.max(PRICE)),
        },
        order=("-total_revenue",),
    ),
    "v_product_performance": View(
        keys=("product_name", "product_category"),
        measures={
            "total_orders": _rows,
            "total_units_sold": _quantity,
            "total_revenue": _revenue,
            "avg_price": _avg_price,
            "avg_order_value": _avg_order,
        },
        share="revenue_share_pct",
        order=("-total_revenue",),
    ),
    "v_top_customers": View(
        keys=("customer_name", "city", "state", "region"),
        measures={
            "total_orders": _rows,
            "total_quantity": _quantity,
            "total_spent": _revenue,
            "avg_order_value": _avg_order,
            "first_purchase": _of(F.min, "sale_date"),
            "last_purchase": _of(F.max, "sale_date"),
        },
        order=("-total_spent",),
    ),
    "v_product_region": View(
        keys=("product_name", "product_category", "region"),
        measures={"total_quantity": _quantity, "total_revenue": _revenue, "avg_price": _avg_price},
        order=("-total_revenue",),
    ),
    "v_product_city": View(
        keys=("product_name", "product_category", "city", "state"),
        measures={"total_quantity": _quantity, "total_revenue": _revenue, "avg_price": _avg_price},
        order=("-total_revenue",),
    ),
    "v_date_summary": View(
        keys=("sale_date",),
        measures={"order_count": _rows, "total_quantity": _quantity, "total_revenue": _revenue},
        not_null=("sale_date",),
        order=("-sale_date",),
    ),
    "v_date_region": View(
        keys=("sale_date", "region"),
        measures={"total_quantity": _quantity, "total_revenue": _revenue, "order_count": _rows},
        not_null=("sale_date",),
        order=("-sale_date", "-total_revenue"),
    ),
    "v_date_city": View(
        keys=("sale_date", "city", "state", "region"),
        measures={"total_quantity": _quantity, "total_revenue": _revenue, "order_count": _rows},
        not_null=("sale_date",),
        order=("-sale_date", "-total_revenue"),
    ),
    "v_heatmap_region_month": View(
        keys=("region", "month"),
        measures={"revenue": _revenue, "total_units": _quantity},
        not_null=("sale_date", "region"),
        by_month=True,
        order=("month", "region"),
    ),
    "v_customer_hierarchy": View(
        keys=("region", "customer_name"),
        measures={"total_quantity": _quantity, "total_spent": _revenue, "total_orders": _rows},
        order=("-total_spent",),
    ),
    "v_pipeline_stats": View(
        keys=("source_file",),
        measures={
            "records_loaded": _rows,
            "first_loaded_at": _of(F.min, "loaded_at"),
            "last_loaded_at": _of(F.max, "loaded_at"),
            "earliest_sale_date": _of(F.min, "sale_date"),
            "latest_sale_date": _of(F.max, "sale_date"),
            "total_revenue": _revenue,
            "unique_customers": _customers,
        },
        order=("-first_loaded_at",),
    ),
}


def register_views(spark: SparkSession, sales: DataFrame) -> None:
    """Make the sales table and all views available to SQL."""
    sales.createOrReplaceTempView("staging_sales")
    for name, view in VIEWS.items():
        view(sales).createOrReplaceTempView(name)
