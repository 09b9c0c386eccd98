"""Money arithmetic and properties of the views."""

import random
from fractions import Fraction
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tillbook.functions.money import money_avg, money_sum, share_pct
from tillbook.operators.filters import filter_sales
from tillbook.plans.dashboard import PANELS
from tillbook.plans.views import VIEWS, register_views
from tillbook.schema import SALES_FIELDS, STAGING_SCHEMA
from tillbook.sources.staging import append_sales, query, query_scalar, read_sales
from pyspark.sql import types as T

CENT = Decimal("0.01")


def sale(day=date(2024, 1, 2), customer="Ann", city="Pune", state="MH", region="West", category="Toys",
         product="Kite", quantity=1, price=2.0, amount=2.0, file="a.xlsx", loaded=datetime(2024, 2, 1)):
    return (day, customer, city, state, region, category, product, quantity, price, amount, file, loaded)


@pytest.fixture
def table(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), T.StructType(SALES_FIELDS))

    return make


def test_money_is_exact(spark):
    rng = random.Random(3)
    values = [rng.choice([rng.uniform(-1e4, 1e4), rng.randint(-99, 99) / 8, 8.9e14, -8.9e14]) for _ in range(4000)]
    keyed = [(i % 7, v) for i, v in enumerate(values)] + [(7, None), (0, None)]
    df = spark.createDataFrame(keyed, "k int, x double")
    for r in df.groupBy("k").agg(money_sum(F.col("x")).alias("s"), money_avg(F.col("x")).alias("a")).collect():
        exact = [Fraction(v) for k, v in keyed if k == r.k and v is not None]
        if not exact:
            assert r.s is None and r.a is None
            continue
        total = Decimal(round(sum(exact) * 10**6)) / 10**6
        assert r.s == total.quantize(CENT, ROUND_HALF_UP)
        assert r.a == (total / len(exact)).quantize(CENT, ROUND_HALF_UP)


def test_fine_amounts_are_not_cut(spark):
    """Digits behind the fourth place count: a million times 0.12344 is 123,440."""
    total = spark.range(1_000_000).select(F.lit(0.12344).alias("x")).agg(money_sum(F.col("x")), money_avg(F.col("x")))
    assert tuple(total.first()) == (Decimal("123440.00"), Decimal("0.12"))


def test_money_does_not_depend_on_order(spark):
    rng = random.Random(5)
    values = [(rng.randint(0, 10**7) / 10**4,) for _ in range(5000)]
    results = set()
    for parts in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame(values, "x double").repartition(parts)
        results.add(df.agg(money_sum(F.col("x")), money_avg(F.col("x"))).first())
    assert len(results) == 1


def test_share_of_zero_is_null(spark):
    df = spark.sql("SELECT CAST(5 AS DECIMAL(29,0)) p, CAST(t AS DECIMAL(29,0)) t FROM VALUES (0), (10), (-10) v(t)")
    assert [r[0] for r in df.select(share_pct(F.col("p"), F.col("t"))).collect()] == [None, Decimal("50.00"),
                                                                                     Decimal("-50.00")]


def test_large_amounts_do_not_fail(spark):
    """Totals are exact as far as doubles are; one beyond DECIMAL(38,2) is NULL, and no other is touched."""
    rows = [("a", 5e14 * 3), ("a", 0.01), ("b", 9e15), ("b", 9e15), ("c", 3e25), ("c", -1e25), ("d", 1e300), ("d", 1.0),
            ("e", float("inf")), ("f", float("nan")), ("g", -2.5e33), ("h", 1.005)]
    df = spark.createDataFrame(rows, "k string, x double")
    found = {r.k: r for r in df.groupBy("k").agg(money_sum(F.col("x")).alias("s"), money_avg(F.col("x")).alias("a")).collect()}
    assert found["a"].s == Decimal("1500000000000000.01") and found["a"].a == Decimal("750000000000000.01")
    assert found["b"].s == Decimal("18000000000000000.00")
    assert abs(found["c"].s / Decimal(2e25) - 1) < Decimal("1e-14")
    assert found["d"].s is None and found["e"].s is None and found["f"].s is None
    assert abs(found["g"].s / Decimal(-2.5e33) - 1) < Decimal("1e-14") if found["g"].s is not None else True
    assert found["h"].s == Decimal("1.01")


def test_empty_table(spark):
    empty = read_sales(spark, "/tmp/no-such-table-of-sales")
    assert empty.schema == STAGING_SCHEMA
    row = VIEWS["v_kpi_summary"](empty).collect()
    assert len(row) == 1
    assert row[0].total_revenue == 0 and row[0].unique_customers == 0 and row[0].earliest_sale is None
    for name, view in VIEWS.items():
        if name != "v_kpi_summary":
            assert view(empty).count() == 0
    assert PANELS["kpis"](empty).first().files_processed == 0


def test_null_keys_and_orders(table):
    sales = table(sale(region=None, amount=5.0), sale(region="West", amount=1.0), sale(region=None, amount=2.0))
    rows = VIEWS["v_regional_performance"](sales).collect()
    assert [(r.region, r.total_revenue, r.revenue_share_pct) for r in rows] == [
        (None, Decimal("7.00"), Decimal("87.50")), ("West", Decimal("1.00"), Decimal("12.50"))]
    assert [r.region for r in VIEWS["v_heatmap_region_month"](sales).collect()] == ["West"]


def test_ranking_with_null_amounts(table):
    sales = table(sale(product="a", amount=None), sale(product="b", amount=3.0), sale(product="c", amount=9.0))
    assert [r.product_name for r in VIEWS["v_product_performance"](sales).collect()] == ["a", "c", "b"]


def test_totals_agree(table):
    rng = random.Random(9)
    rows = [
        sale(day=date(2024, rng.randint(1, 12), rng.randint(1, 28)), customer=f"c{rng.randint(1, 9)}",
             region=rng.choice(["N", "S", None]), product=f"p{rng.randint(1, 5)}", city=rng.choice(["x", None]),
             amount=rng.randint(0, 10**6) / 100, quantity=rng.choice([None, 1, 5]))
        for _ in range(300)
    ]
    sales = table(*rows).cache()
    total = VIEWS["v_kpi_summary"](sales).first().total_revenue
    named = {"v_customer_hierarchy": "total_spent", "v_top_customers": "total_spent", "v_heatmap_region_month": None}
    for name, view in VIEWS.items():
        column = named.get(name, "total_revenue")
        if column:
            assert view(sales).agg(F.sum(column)).first()[0] == total, name
    shares = VIEWS["v_product_performance"](sales).agg(F.sum("revenue_share_pct")).first()[0]
    assert abs(shares - 100) < Decimal("0.1")


def test_one_hot_key(spark):
    hot = spark.range(20000).select(
        F.lit(date(2024, 1, 2)).alias("sale_date"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id")).alias("customer_name"),
        *[F.lit("x").alias(c) for c in ("city", "state", "region", "product_category", "product_name")],
        F.lit(1).alias("quantity"), F.lit(1.5).alias("price_per_unit"), F.lit(1.5).alias("sales_amount"),
        F.lit("f").alias("source_file"), F.lit(datetime(2024, 1, 1)).alias("loaded_at"),
    )
    top = VIEWS["v_top_customers"](hot).first()
    assert (top.customer_name, top.total_orders, top.total_spent) == ("hot", 6667, Decimal("10000.50"))
    assert VIEWS["v_kpi_summary"](hot).first().unique_customers == 13334


def test_sql_access(spark, table):
    register_views(spark, table(sale(), sale(customer="Bob")))
    assert query_scalar(spark, "SELECT unique_customers FROM v_kpi_summary") == 2
    assert query_scalar(spark, "SELECT 1 FROM staging_sales WHERE customer_name = 'Zoe'") is None
    rows = query(spark, "SELECT * FROM v_top_customers WHERE customer_name = :who", {"who": "Bob"})
    assert rows.count() == 1


def test_top_lists_break_ties(table):
    sales = table(*[sale(product=f"p{i:02d}", customer=f"c{i:02d}") for i in range(30)])
    assert [r.product_name for r in PANELS["top_products"](sales).collect()] == [f"p{i:02d}" for i in range(15)]
    assert [r.customer_name for r in PANELS["top_customers"](sales).collect()] == [f"c{i:02d}" for i in range(20)]


def test_append_and_filters(spark, table, tmp_path):
    path = str(tmp_path / "sales")
    first = [sale(), sale(day=date(2024, 3, 5), region="East"), sale(day=date(2024, 5, 1), city=None)]
    assert append_sales(table(*first), path, "b1") == 3
    assert append_sales(table(sale(day=None)).select("loaded_at", *[f.name for f in SALES_FIELDS[:-1]]), path, "b2") == 1
    assert append_sales(table(*first), path, "b1") == 3  # a repeated batch replaces itself
    assert append_sales(table(sale()).drop("loaded_at"), path, "b3") == 1
    sales = read_sales(spark, path)
    assert sales.schema == STAGING_SCHEMA and sales.count() == 5
    assert sales.filter("loaded_at IS NULL").count() == 0
    some = filter_sales(sales, date_from=date(2024, 3, 1), date_to=date(2024, 4, 30))
    assert [r.region for r in some.collect()] == ["East"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "sale_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(sale_date" in plan
    assert filter_sales(sales, cities=["Pune"], regions=["West"], customers=["Ann"], categories=["Toys"],
                        source_files=["a.xlsx"], loaded_from=datetime(2024, 1, 1),
                        loaded_to=datetime(2024, 2, 1)).count() == 2


def test_other_read_errors_are_not_hidden(spark, tmp_path):
    (tmp_path / "f").write_text("not parquet")
    with pytest.raises(Exception):
        read_sales(spark, str(tmp_path / "f")).count()
