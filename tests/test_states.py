"""Panels brought up to date from new batches."""

import math
import random
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillbook.functions.sketch import STANDARD_ERROR, estimate, merged_sketch, sketch
from tillbook.plans.dashboard import PANELS
from tillbook.plans.states import PanelStates, refresh_panels
from tillbook.schema import SALES_FIELDS
from tillbook.streaming.ingest import SalesStore, append_batch

SCHEMA = "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in SALES_FIELDS) + ">"


def sales(seed, n):
    rng = random.Random(seed)
    amounts = [None, -3.5, 0.005, 1e16, 12.345678901, 7.0, -0.005]
    pick = lambda *v: rng.choice(v)
    return [
        (
            date(2024, 1, 1 + rng.randrange(9)), f"C{rng.randrange(40)}", pick("a", "b", None), pick("s", None), pick("r", "q", None),
            pick("x", "y", None), f"P{rng.randrange(5)}", pick(None, 1, 2, -7), rng.choice(amounts), rng.choice(amounts),
            f"f{seed}.xlsx", datetime(2024, 2, 1 + seed),
        )
        for _ in range(n)
    ]


def rows(df):
    return sorted(map(str, df.collect()))


def test_panels_after_each_batch_without_old_rows(spark, tmp_path):
    """Folders of old batches are removed before each refresh: their rows aren't needed."""
    store, seen = SalesStore(str(tmp_path)), []
    assert rows(refresh_panels(spark, store)["kpis"]) == rows(PANELS["kpis"](store.sales(spark)))
    for n, size in enumerate((60, 1, 90)):
        seen += sales(n, size)
        append_batch(spark.createDataFrame(sales(n, size), SCHEMA), store, f"b{n}")
        panels = refresh_panels(spark, store)
        everything = spark.createDataFrame(seen, SCHEMA)
        for name, panel in PANELS.items():
            assert rows(panels[name]) == rows(panel(everything)), (n, name)
        for folder in (tmp_path / "staging_sales").iterdir():
            shutil.rmtree(folder)
    before = PanelStates(spark, store)._latest()
    refresh_panels(spark, store)  # nothing new
    assert PanelStates(spark, store)._latest() == before


def test_a_refresh_reads_the_new_batches_only(spark, tmp_path):
    store = SalesStore(str(tmp_path))
    for n in range(3):
        append_batch(spark.createDataFrame(sales(n, 20), SCHEMA), store, f"b{n}")
        new, number = PanelStates(spark, store).new_rows(PanelStates(spark, store)._latest()["number"] if n else 0)
        assert {f.split("batch_id=")[1].split(".")[0] for f in new.inputFiles()} == {f"b{n}"}
        refresh_panels(spark, store)
        assert PanelStates(spark, store)._latest()["number"] == number


def test_merged_sketches_are_those_of_all_rows(spark, tmp_path):
    numbers = spark.range(60_000).select((F.col("id") % 3).alias("key"), (F.col("id") % 5).alias("batch"), F.expr("CAST(id * 7 % 30000 AS STRING)").alias("value"))
    once = numbers.groupBy("key").agg(sketch("value").alias("seen"))
    parts = numbers.groupBy("key", "batch").agg(sketch("value").alias("seen"))
    parts.write.parquet(f"{tmp_path}/sketches")
    merged = spark.read.parquet(f"{tmp_path}/sketches").groupBy("key").agg(merged_sketch("seen").alias("seen"))
    of = lambda df: {r.key: r.n for r in df.select("key", estimate("seen").alias("n")).collect()}
    exact = {r.key: r.n for r in numbers.groupBy("key").agg(F.count_distinct("value").alias("n")).collect()}
    whole, joint = of(once), of(merged)
    assert set(joint) == set(exact)
    for key, n in exact.items():
        assert abs(joint[key] - n) <= 3 * STANDARD_ERROR * n and abs(whole[key] - joint[key]) <= 2 * STANDARD_ERROR * n
    assert math.isclose(STANDARD_ERROR, 0.01625)


@pytest.mark.parametrize("approximate", [False, True])
def test_empty_store(spark, tmp_path, approximate):
    panels = refresh_panels(spark, SalesStore(str(tmp_path)), approximate)
    assert panels["kpis"].first().unique_customers == 0 and panels["regional"].count() == 0


@pytest.mark.parametrize("approximate", [False, True])
def test_a_refresh_goes_three_times_through_the_new_rows(spark, tmp_path, monkeypatch, approximate):
    """Once per grouping, however many panels and distinct counts are made from it."""
    store, new_rows, read = SalesStore(str(tmp_path)), PanelStates.new_rows, spark.sparkContext.accumulator(0)

    def seen(_):
        read.add(1)
        return True

    def counted(self, since):
        rows, number = new_rows(self, since)
        return rows.filter(F.udf(seen, "boolean")("source_file")), number

    monkeypatch.setattr(PanelStates, "new_rows", counted)
    for n in range(2):
        append_batch(spark.createDataFrame(sales(n, 20), SCHEMA), store, f"b{n}")
        PanelStates(spark, store, approximate).refresh()
        assert read.value == 3 * 20 * (n + 1)
    total = PANELS["kpis"](spark.createDataFrame(sales(0, 20) + sales(1, 20), SCHEMA)).first()
    assert PanelStates(spark, store, approximate).panels()["kpis"].first().total_revenue == total.total_revenue
