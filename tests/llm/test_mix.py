import pytest
from pyspark.sql import functions as F

from tillbook.llm.mix import cycle_weights, mix, water_fill


def fill(rows, share, most):
    """Water-filling by repeated clamping, in plain arithmetic."""
    budget, clamped = share * sum(s for _, s, _ in rows), {}
    while True:
        free = [(k, s, w) for k, s, w in rows if k not in clamped]
        weight = sum(w for *_, w in free)
        level = (budget - sum(clamped.values())) / weight if weight else 0
        new = {k: most * s for k, s, w in free if w * level > most * s}
        clamped |= new
        if not new:
            return {k: clamped.get(k, w * level) for k, _, w in rows}


@pytest.mark.parametrize("share", [0.1, 1.0, 1.5, 2.0])
def test_targets(spark, share):
    rows = [("a", 100, 3.0), ("b", 4000, 1.0), (None, 10, 2.0), ("c", 900, 3.0), ("d", 0, 1.0), ("é", 50, 0.5)]
    frame = spark.createDataFrame(rows, "source string, source_size long, weight double")
    found = {r["source"]: r["target"] for r in water_fill(frame, share, 2.0).collect()}
    assert found == pytest.approx(fill(rows, share, 2.0))


def test_weights_cycle_by_code_point(spark):
    names = ["b", "a", "Z", "é", "\U0001f600", "￿", None, "ab"]
    frame = spark.createDataFrame([(n, 1) for n in names], "source string, source_size long").repartition(3)
    found = {r["source"]: r["weight"] for r in cycle_weights(frame).collect()}
    order = [*sorted(n for n in names if n is not None), None]
    assert found == {n: (3.0, 1.0, 2.0)[i % 3] for i, n in enumerate(order)}


def test_taken_words(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i * i % 37)) for i in range(2000)]
    rows += [(5000, "long", "w " * 10_000), (5001, "long", "w"), (None, None, "w w"), (7, None, None), (8, "none", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    mixed = mix(docs)
    assert mixed.count() == len(rows)
    assert mixed.where("taken < 0 OR taken > 2 * size").count() == 0
    per_source = mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.sum("size").alias("n"), F.max("source_size").alias("size"))
    for r in per_source.collect():
        assert r["taken"] == int(r["target"]) and r["n"] == r["size"]
    again = mix(docs.repartition(7))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    other = mix(docs, seed="another")
    assert sorted(map(str, mixed.select("doc_id", "taken").collect())) != sorted(map(str, other.select("doc_id", "taken").collect()))


def test_given_weights(spark):
    docs = spark.createDataFrame([(1, "a", "x y"), (2, "b", "x y"), (3, "c", "x")], "doc_id long, source string, text string")
    weights = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 0.0)], "source string, weight double")
    found = {r["source"]: r["taken"] for r in mix(docs, weights=weights).collect()}
    assert found == {"a": 4, "b": 0, "c": 0}


def test_odd_documents(odd, no_documents):
    found = mix(odd)
    assert found.count() == odd.count() and found.columns.count("taken") == 1
    assert found.where("text IS NULL AND (size <> 0 OR taken <> 0)").count() == 0
    assert mix(no_documents).count() == 0


def test_target_among_equal_rows(spark):
    """The target falls among rows of one id: many texts, and many copies of one."""
    rows = [(None, "hot", "w " * (1 + i % 5)) for i in range(600)] + [(None, "hot", f"x{i} y") for i in range(300)]
    rows += [(9, "hot", None)] * 50 + [(i, "cold", "a b c") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    weights = spark.createDataFrame([("hot", 1.0), ("cold", 1.0)], "source string, weight double")
    for share in (0.05, 0.37, 0.8, 1.5):
        mixed = mix(docs, weights=weights, share=share)
        assert mixed.count() == len(rows) and mixed.where("taken < 0 OR taken > 2 * size").count() == 0
        for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
            assert r["taken"] == int(r["target"])
        again = mix(docs.repartition(3), weights=weights, share=share)
        assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
