import math

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillbook.llm import outliers
from tillbook.llm.outliers import D, chi_square, chi_square_quantile, estimate, judge, next_model
from tillbook.llm.queries import QUERIES
from tillbook.llm.textrules import COUNTS, MORE, text_counts, with_counts


def plain_counts(text):
    """The base statistics by the words of the contract."""
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
    }


def test_counts_equal_plain_python(spark):
    import pyarrow as pa

    docs = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts = [None, "", "a b a b a b", "x\nx\n x\n\n \nx", "é é é é é é", "a a a", "a a a a", "\x1c a\x0bb\x0cc\r\nd", *docs, "#|<> " * 40]
    counts = text_counts(pa.array(texts))
    for i, text in enumerate(texts):
        assert {c: int(counts[c][i]) for c in COUNTS} == plain_counts(text), text


def test_base_columns_of_the_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op13_outliers"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        plain = plain_counts(texts[row["doc_id"]])
        assert {c: row[c] for c in COUNTS} == plain
        assert row["base_failed"] == (plain["n_words"] < 50 or 100 * plain["n_repeat_words"] > 50 * plain["n_words"])
        assert not (row["base_failed"] and row["kept"])


def test_chi_square():
    # Fixed values of tables: the 95 % point of 6 degrees, and the distribution function of 8 degrees at 7.344.
    assert abs(chi_square_quantile(0.05, 6) - 12.592) < 1e-3
    assert abs(chi_square(7.344, 8) - 0.5) < 1e-3


def plain_estimate(x, least):
    """The same estimate over one matrix, row by row."""
    center = np.array([math.floor(sorted(np.floor(c / 0.01))[math.ceil(0.5 * len(c)) - 1]) * 0.01 + 0.005 for c in x.T])
    low, high = (np.array([sorted(np.floor(c / 0.01))[math.ceil(q * len(c)) - 1] * 0.01 for c in x.T]) for q in (0.25, 0.75))
    cov = np.diag(np.maximum((high - low) / 1.349, least) ** 2)
    far = lambda: np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)

    def of(inside):
        share = min(inside.mean(), 0.975)
        c = np.cov(x[inside].T, bias=True) * share / chi_square(chi_square_quantile(1 - share, D), D + 2)
        return x[inside].mean(axis=0), c + np.diag(np.maximum(least**2 - np.diag(c), 0)) + 1e-9 * np.eye(D)

    spread = None
    for _ in range(outliers.STEPS):
        bins = np.clip(np.floor(np.log2(np.maximum(far(), 2.0**-4)) * 16), -64, 320)
        cut = np.sort(bins)[math.ceil(0.75 * len(x)) - 1]
        center, cov = of(bins <= cut)
        before, spread = spread, np.linalg.slogdet(cov)[1] / 2
        if before is not None and abs(spread - before) <= outliers.SETTLED:
            break
    center, cov = of(far() <= chi_square_quantile(0.025, D))
    return far()


def test_distances_equal_plain_numpy(spark, monkeypatch):
    rng = np.random.default_rng(5)
    groups, rows = {("en", "a"): 400, ("en", None): 150, (None, "a"): 90, ("fr", "x"): 40, ("fr", "y"): 30, ("de", "z"): 12}, []
    for (lang, source), n in groups.items():
        for _ in range(n):
            words = int(rng.integers(60, 900))
            bad = rng.random() < 0.15
            counts = [words, int(words * rng.normal(5, 0.2)), int(words * (0.5 if bad else 0.01 * rng.random())), 0, int(words * 0.2 * rng.random())]
            more = [int(rng.integers(5, 20)), int(words * rng.normal(0.15, 0.01)), int(words * rng.normal(0.1, 0.01)), 3, 5 * words]
            rows.append((lang, source, *counts, *more))
    frame = pd.DataFrame(rows, columns=["lang", "source", *COUNTS, *MORE])
    docs = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} long" for c in (*COUNTS, *MORE)))
    docs = docs.withColumn("id", F.monotonically_increasing_id()).coalesce(3)
    found = {r["id"]: r for r in judge(docs, estimate(docs)).collect()}
    order = [r["id"] for r in docs.collect()]
    x = outliers._vectors(docs, "lang", "source").select("row.id", *[f"x{i}" for i in range(D)]).toPandas().set_index("id").loc[order].to_numpy()
    for own in ([k] for k in [("en", "a"), ("en", None), (None, "a")]):
        _compare(frame, found, order, x, own)
    _compare(frame, found, order, x, [("fr", "x"), ("fr", "y")])
    assert all(found[i]["kept"] and found[i]["distance"] is None for i, g in zip(order, rows, strict=True) if g[0] == "de")


def _compare(frame, found, order, x, own):
    named = list(zip(frame["lang"].where(frame["lang"].notna(), None), frame["source"].where(frame["source"].notna(), None), strict=True))
    at = [i for i, key in enumerate(named) if key in own]
    far = plain_estimate(x[at], outliers._floor())
    got = np.array([found[order[i]]["distance"] for i in at])
    assert np.allclose(got, far, rtol=1e-6, atol=1e-6)
    assert [found[order[i]]["kept"] for i in at] == (far <= chi_square_quantile(outliers.TAIL, D)).tolist()


def test_one_unit_of_equal_rows():
    n, row = 200, np.array([1.6, 0.01, 0.05, 0.1, 0.2, 0.3])
    sums = {f"s{i}": [n * row[i]] for i in range(D)} | {f"p{i}_{j}": [n * row[i] * row[j]] for i in range(D) for j in range(i + 1)}
    model = next_model(pd.DataFrame({"bin": [-64], "n": [n], **sums}), 0.75, outliers._floor())
    assert np.allclose(model["center"][0], row) and np.isfinite(model["factor"][0]).all()


def test_junk_goes_and_clean_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    counted = with_counts(docs, "text", ["doc_id", "lang", "source"])
    judged = judge(counted, estimate(counted)).where("NOT base_failed").join(labels, "doc_id").collect()
    clean, junk = ([r["kept"] for r in judged if r["quality"] == q] for q in (1, 0))
    assert all(clean) and sum(junk) <= 0.1 * len(junk)


def test_odd_documents(spark, odd, no_documents):
    counted = with_counts(odd.withColumn("kept", F.lit("x")), "text", odd.columns + ["kept"])
    found = judge(counted, estimate(counted, least=2))
    assert found.count() == odd.count() and found.columns.count("kept") == 1 and set(odd.columns) <= set(found.columns)
    assert found.where("kept IS NULL OR base_failed IS NULL OR n_words IS NULL").count() == 0
    empty = with_counts(no_documents, "text", no_documents.columns)
    assert judge(empty, estimate(empty)).count() == 0
    assert judge(counted, estimate(empty)).where("NOT kept AND NOT base_failed").count() == 0
    with pytest.raises(Exception, match="nowhere"):
        estimate(counted, lang="nowhere")
