"""Rows along a curve: filters on each column skip row groups."""

import random
from bisect import bisect_right

import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillbook.operators.filters import filter_sales
from tillbook.sources.clustering import along_curve, curve_place, range_starts
from tillbook.sources.staging import append_sales, read_sales
from tillbook.sources.star import star_sales
from tillbook.streaming.ingest import SalesStore, append_batch

COLUMNS = ("region", "city", "product_category", "customer_name")


def groups_read(path, column, values):
    """Row groups whose statistics let a value in, as a share of all; the mean over the values."""
    met = total = 0
    for name in ds.dataset(path, format="parquet", partitioning="hive").files:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += len(values)
            met += len(values) if not stats.has_min_max else sum(stats.min <= v <= stats.max for v in values)
    assert total > 100 * len(values)
    return met / total


def test_each_filter_skips_row_groups(spark, tmp_path):
    # One month, so that only the order within it can help.
    sales = star_sales(spark, "/root/testdata/sf0.01").withColumn("sale_date", F.lit("1997-05-01").cast("date")).cache()
    settings = {"parquet.block.size": "6000", "parquet.page.size.row.check.min": "10", "parquet.page.size.row.check.max": "20"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        append_sales(sales, f"{tmp_path}/sorted", "b")
        append_sales(sales, f"{tmp_path}/curve", "b", COLUMNS)
    finally:
        for k in settings:
            spark.conf.unset(k)
    some = {c: [r[c] for r in sales.where(F.col(c).isNotNull()).select(c).distinct().orderBy(F.xxhash64(c)).limit(20).collect()] for c in COLUMNS}
    shares = {c: [groups_read(f"{tmp_path}/{t}", c, some[c]) for t in ("sorted", "curve")] for c in COLUMNS}
    assert shares["product_category"][0] > 0.99 and shares["product_category"][1] < 0.62  # 1.00 and 0.56 as measured
    assert shares["customer_name"][1] < 0.65 * shares["customer_name"][0]  # 0.12 and 0.06
    assert shares["region"][1] < 0.4 and shares["city"][1] < 0.06  # 0.32 and 0.04, 0.21 and 0.02 where sorted by them
    for c, given in zip(COLUMNS, ("regions", "cities", "categories", "customers"), strict=True):
        found = filter_sales(read_sales(spark, f"{tmp_path}/curve"), **{given: [some[c][0]]})
        assert found.count() == sales.where(F.col(c) == some[c][0]).count() > 0
    assert read_sales(spark, f"{tmp_path}/curve").count() == sales.count()


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_ranges_and_places_against_plain_ones(spark, bits):
    chance = random.Random(bits)
    rows = [(chance.choice([None, "hot", "hot", "hot", f"v{chance.randint(0, 300)}"]), chance.choice(["a", "é", "", None])) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "x string, y string").repartition(5)
    starts = range_starts(frame, ["x", "y"], bits)
    for i, c in enumerate("xy"):
        values = sorted(r[i] for r in rows if r[i] is not None)
        plain = {}
        for at, v in enumerate(values):
            if at == 0 or values[at - 1] != v:
                plain.setdefault(at * 2**bits // len(values), v)
        assert starts[c] == [v for k, v in sorted(plain.items()) if k]
    for r in frame.distinct().withColumn("place", curve_place(starts, bits)).collect():
        numbers = [0 if r[c] is None else bisect_right(starts[c], r[c]) for c in "xy"]
        text = "".join(f"{numbers[0]:0{bits}b}"[b] + f"{numbers[1]:0{bits}b}"[b] for b in range(bits))
        assert r["place"] == int(text, 2)


def test_odd_rows(spark, tmp_path):
    sales = star_sales(spark, "/root/testdata/sf0.001")
    nothing = sales.limit(0)
    assert append_sales(nothing, f"{tmp_path}/none", "b", COLUMNS) == 0
    blank = sales.limit(50).withColumns({c: F.lit(None).cast("string") for c in COLUMNS}).withColumn("sale_date", F.lit(None).cast("date"))
    store = SalesStore(f"{tmp_path}/store", cluster_by=COLUMNS)
    assert append_batch(blank.union(blank), store, "b") == 100
    assert store.sales(spark).where("region IS NULL AND sale_month = 'none'").count() == 100
    with pytest.raises(ValueError):
        curve_place({c: [] for c in "abcdefghijk"}, 6)


def test_rows_are_made_twice_and_large_months_cut_along_the_curve(spark):
    """Once to count values, once to be dealt; each stretch of a month lies together, as far as it is small."""
    read = spark.sparkContext.accumulator(0)

    def seen(_):
        read.add(1)
        return True

    values = [(f"m{i % 2}", f"x{i % 50:02d}", None if i % 9 == 0 else f"y{i % 7}", i) for i in range(2000)] * 2
    rows = spark.createDataFrame(values, "sale_month string, x string, y string, i int")
    curve = along_curve(rows.filter(F.udf(seen, "boolean")("i")), ["x", "y"], cell_rows=500)
    assert read.value == len(values)
    dealt = curve.withColumns({"task": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).collect()
    assert read.value == 2 * len(values)
    assert sorted(r["i"] for r in dealt) == sorted(v[3] for v in values)
    place = curve_place(range_starts(rows, ["x", "y"]))
    placed = {(r.sale_month, r.x, r.y): r.place for r in rows.distinct().select("*", place.alias("place")).collect()}
    tasks, last = {}, {}
    for r in sorted(dealt, key=lambda r: r["at"]):
        at = placed[r.sale_month, r.x, r.y]
        tasks.setdefault((r.sale_month, at >> 9), set()).add(r["task"])
        assert last.get(r["task"], ("", 0)) <= (r.sale_month, at)
        last[r["task"]] = (r.sale_month, at)
    assert len(tasks) == 8 and all(len(t) == 1 for t in tasks.values())
