import numpy as np
from pyspark.sql import functions as F

from tillbook.llm.nearest import build_index, exact, nearest


def brute(rows, k):
    out = []
    for i, (q, v) in enumerate(rows):
        if q % 20:
            continue
        one = np.zeros(1, dtype=int)
        scores = [(-exact(np.array([v]), one, np.array([w]), one)[0], c) for j, (c, w) in enumerate(rows) if j != i]
        out += [(q, rank + 1, c, -s) for rank, (s, c) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def search(frame, **options):
    index, space = build_index(frame, vector="v")
    found = nearest(index, space, F.col("vec_id") % 20 == 0, **options)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centers = rng.standard_normal((12, 48))
    vectors = centers[rng.integers(12, size=3000)] + rng.standard_normal((3000, 48))
    vectors[1000:1400] = vectors[1000]  # a common vector: ties by id
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found, expected = search(spark.createDataFrame(rows, "vec_id long, v array<double>").repartition(5)), brute(rows, 20)
    assert len(found) == len(expected)
    assert len(set(found) & set(expected)) >= 0.999 * len(expected)


def test_blocks_of_queries_give_the_same(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((600, 8)))]
    frame = spark.createDataFrame(rows, "vec_id long, v array<float>")
    assert search(frame, block=7) == search(frame)


def test_vectors_that_take_no_part(spark):
    good = [(20, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, -1.0]), (40, [0.5, 0.5]), (3, [1.0, 2.0])]
    bad = [(60, None), (80, []), (5, [0.0, 0.0]), (7, [1.0, None]), (9, [1.0, float("nan")]), (11, [float("inf"), 1.0]), (13, [1.0]), (None, [9.0, 9.0])]
    frame = spark.createDataFrame(good + bad, "vec_id long, v array<double>").withColumn("score", F.lit(1))
    found = search(frame)
    assert found == brute(good, 20)
    assert [r[2] for r in found if r[:1] == (20,)][:4] == [3, 3, 20, 20] and len(found) == 12
    assert search(frame.limit(0)) == []
