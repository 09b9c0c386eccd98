import random

import pytest
from pyspark.sql import functions as F

from tillbook.plans.order import disorder
from tillbook.plans.views import down, up


@pytest.mark.parametrize("order", [("a",), ("-a",), ("-a", "b"), ("a", "-b")])
def test_sorted_rows_are_in_order_and_others_are_counted(spark, order):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    keys = [down(c[1:]) if c.startswith("-") else up(c) for c in order]
    found = disorder(df.repartition(7).orderBy(*keys), order, "x").first()
    assert (found.name, found.n_rows, found.n_out_of_order) == ("x", 200, 0)

    def place(row, name):
        value = row[0 if name.endswith("a") else 1]
        values = [None, 3, 2, 1] if name == "-a" else [None, "y", "x"] if name == "-b" else [1, 2, 3, None] if name == "a" else ["x", "y", None]
        return values.index(value)

    whole = spark.createDataFrame(rows, "a int, b string").coalesce(3)
    stood = [tuple(r) for r in whole.collect()]
    wrong = sum([place(p, n) for n in order] > [place(c, n) for n in order] for p, c in zip(stood, stood[1:], strict=False))
    assert disorder(whole, order, "x").first().n_out_of_order == wrong > 0


def test_no_rows(spark):
    found = disorder(spark.range(0).select(F.col("id").alias("a")), ("a",), "x").first()
    assert (found.n_rows, found.n_out_of_order) == (0, 0)
