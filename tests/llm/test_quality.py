import numpy as np
from conftest import SMALL  # noqa: F401
from pyspark.sql import functions as F

from tillbook.llm.queries import held_out
from tillbook.llm.quality import FOLDS, SHRINK_DIAGONAL, SHRINK_POOLED, STATISTICS, _moments, choose_shrinkage, fit, score_quality, train_quality


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = train_quality(docs.where(~held_out(5, 0)), labels)
    scored = score_quality(docs, model, keep=["doc_id"]).where(held_out(5, 0)).join(labels, "doc_id")
    right = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count(F.lit(1))).first()
    assert right[1] > 50 and right[0] >= 0.97


def test_densities_are_those_of_the_formula():
    rng = np.random.default_rng(0)
    d = len(STATISTICS)
    x = {0: rng.standard_normal((200, d)) * 2 + 1, 1: rng.standard_normal((900, d))}
    ones = {c: np.column_stack([np.ones(len(v)), v]) for c, v in x.items()}
    model = fit({c: v.T @ v for c, v in ones.items()}, pooled=0.0, diagonal=0.0)

    def density(c, row):
        cov = np.cov(x[c].T, bias=True)
        far = row - x[c].mean(axis=0)
        return -0.5 * (far @ np.linalg.solve(cov, far) + np.linalg.slogdet(cov)[1])

    for row in rng.standard_normal((20, d)):
        odds = density(1, row) - density(0, row) + np.log(901 / 201)
        assert abs(model.scores(row[None])[0] - 1 / (1 + np.exp(-odds))) < 1e-3


def test_odd_documents(spark, odd, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, 0), (5, None), (None, 1), (9, 7)], "doc_id long, quality int")
    model = train_quality(odd, labels)
    found = score_quality(odd, model)
    assert found.count() == odd.count() and found.columns.count("score") == 1
    assert found.where("score IS NULL OR isnan(score) OR score < 0 OR score > 1").count() == 0
    assert found.where("predicted <> CAST(score >= 0.3 AS INT)").count() == 0
    assert score_quality(no_documents, model).count() == 0
    unlearnt = train_quality(no_documents, labels.limit(0))
    assert {r["score"] for r in score_quality(odd, unlearnt).collect()} == {0.5}
    one_class = train_quality(odd, labels.where("quality = 1"))
    assert {round(r["score"], 6) for r in score_quality(odd, one_class).collect()} == {round(3 / 4, 6)}


def test_shrinkage_is_chosen_by_the_folds(spark):
    """Every pair's error, and the choice, as by a plain loop over the training rows."""
    rng = np.random.default_rng(8)
    d, n = len(STATISTICS), 240
    label = (rng.random(n) < 0.7).astype(int)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    x = rng.standard_normal((n, d)) * np.linspace(0.2, 3, d) @ turn * np.where(label == 1, 1, 1.6)[:, None] + 0.4 * label[:, None]
    fold = np.arange(n) % FOLDS
    rows = [(int(c), [float(v) for v in r], int(f)) for c, r, f in zip(label, x, fold, strict=True)]
    labelled = spark.createDataFrame(rows, "label long, statistics array<double>, fold long").repartition(3)
    errors = {}
    for p in SHRINK_POOLED:
        for q in SHRINK_DIAGONAL:
            missed = np.zeros(2)
            for f in range(FOLDS):
                ones = np.column_stack([np.ones(n), x])
                own = {c: ones[(fold != f) & (label == c)] for c in (0, 1)}
                model = fit({c: v.T @ v for c, v in own.items()}, p, q)
                at = fold == f
                wrong = (model.scores(x[at]) >= 0.3) != label[at]
                missed += np.bincount(label[at][wrong], minlength=2)
            errors[p, q] = round(missed[0] / (label == 0).sum() + missed[1] / (label == 1).sum(), 12)
    assert choose_shrinkage(labelled, _moments(labelled)) == min(errors, key=errors.get)
