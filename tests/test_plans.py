"""The executed plans must hold at scale."""

import re
from datetime import datetime

import pytest

import __spark_entry__ as contract
from tillbook.operators.verdict import count_rows
from tillbook.plans import catalog
from tillbook.plans.catalog import shared_folder
from tillbook.plans.views import VIEWS

SF_DIR = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


GROUPED = ["regional_performance", "product_city", "date_city", "top_customers", "pipeline_stats"]


@pytest.mark.parametrize("name", GROUPED)
def test_views_aggregate_before_the_shuffle(spark, name):
    plan = final_plan(contract.queries()[name](spark, SF_DIR))
    assert "partial_sum" in plan and "Window" not in plan
    assert not re.search("CartesianProduct|NestedLoopJoin|SortAggregate|ObjectHashAggregate", plan)
    assert not re.search("decimal.*partial_sum", plan)


def test_share_reads_the_total_once(spark):
    plan = final_plan(contract.queries()["regional_performance"](spark, SF_DIR))
    assert len(re.findall(r"- Subquery subquery", plan)) == 1 and "ReusedSubquery" in plan


def test_top_lists_keep_only_leading_rows(spark):
    plan = final_plan(contract.queries()["dash_top_customers"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_only_needed_columns_are_read(spark):
    plan = final_plan(contract.queries()["date_summary"](spark, SF_DIR))
    schema = re.search("ReadSchema: struct<(.*?)>", plan)[1]
    assert schema == "sale_date:date,quantity:int,sales_amount:double"


def test_cleaning_does_not_shuffle_rows(spark):
    plan = final_plan(contract.queries()["clean_sales"](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("translate(") <= 2  # converted once, not again in a pushed filter


def test_rejected_rows_are_found_without_a_shuffle(spark):
    plan = final_plan(contract.queries()["quarantined_rows"](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_filters_prune_months(spark):
    plan = final_plan(contract.queries()["filtered_sales"](spark, SF_DIR))
    assert "sale_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(sale_date" in plan and "In(region" in plan


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_all_views_are_registered():
    assert len(VIEWS) == 16 and {v.removeprefix("v_") for v in VIEWS} <= set(catalog.queries())
    assert len(catalog.queries()) == 61


def test_raw_rows_of_a_file_lie_together(spark, tmp_path, monkeypatch):
    day = datetime(2020, 1, 2)
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"Customer#{i}" if i else None, 0) for i in range(5)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(0, "bolt", "PROMO", 9.5)], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": ([(i, i % 5, day) for i in range(10)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "lineitem": (
            [(i % 10, 0, i // 10, 1.0, 8.0, 0.5, day) for i in range(40)],
            "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(catalog, "_ROWS_PER_BUCKET", 10)
    rows = catalog.landing_rows(spark, str(tmp_path))
    counted = count_rows(rows, "n")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    names = [None, *[f"inbox/Customer_{i}.xlsx" for i in range(1, 5)]]
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([(n, 8) for n in names], key=str)
    assert sorted(map(tuple, rows.select("path", "source_file").distinct().collect()), key=str) == sorted([(n, n and n[6:]) for n in names], key=str)
