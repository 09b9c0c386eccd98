import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbook.llm import lexical
from tillbook.llm.lexical import query_terms, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    """By the words of the contract, in whole numbers."""
    held = [(i, Counter(t), len(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c, n in held:
            m = 75 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, k, **named):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in search(docs, items, k=k, **named).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [" ".join(f"T{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.choice([1, 5, 5, 5, 30, 200]))) for _ in range(n)]
    texts += ["t1 t2 t3"] * 40 + ["", None, "!!! ???", "Ünï t1 ünï", "ÜNÏ"]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)]
    items = [(0, "t1 t2 t2 t50"), (1, "Ünï"), (2, "nowhere"), (3, None), (4, ""), (5, " ".join(f"t{i}" for i in range(60))), (None, "t7"), (5, "t3 t3 t3"), (5, "t3 t3 t3")]
    return rows, items


@pytest.mark.parametrize("rows, block", [(1024, 1 << 20), (7, 1 << 20), (3, 12)])
def test_equal_to_brute_force(spark, monkeypatch, rows, block):
    """Also with parts of few documents, and queries in many blocks."""
    monkeypatch.setattr(lexical, "ROWS", rows)
    documents, items = corpus(rows, 300)
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    queries = spark.createDataFrame(items, "item_id long, text string")
    for k in (1, 20):
        assert found(docs, queries, k, block_bytes=block) == plain_search(documents, items, k)


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(2)
    asked = query_terms(pa.array(["a b b c", "c d", "e"]), np.arange(3))
    block = lexical._Block(asked, rng.integers(0, 5000, asked.hashes.size))
    tfs = rng.integers(0, 9, (50, asked.hashes.size))
    for m in (75, 100, 4000):
        top = tfs.max(axis=0)
        held = np.flatnonzero(top)
        bounds = block.bounds(m, held, top[held])
        gains = lexical.impacts(tfs, m) * block.weights
        for q in range(len(asked)):
            own = slice(asked.first[q], asked.first[q + 1])
            assert (gains[:, asked.term[own]] @ asked.times[own] <= bounds[q]).all()
        assert (block.bounds(m, held, tfs[0][held]) <= bounds).all()


def test_large_scores_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(lexical, "EXACT", 1.0)
    documents, items = corpus(9, 100)
    docs, queries = spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(docs, queries, 20) == plain_search(documents, items, 20)


def test_odd_documents(spark, odd, no_documents):
    items = spark.createDataFrame([("a", "alpha BETA one"), ("b", "漢字"), ("c", None)], "item_id string, text string")
    rows = search(odd.withColumn("rank", F.lit(1)), items.withColumn("query_row", F.lit(5)), k=3).collect()
    assert [(r["doc_id"], r["rank"]) for r in rows if r["item_id"] == "b"] == [(9, 1)]
    assert sorted(r["rank"] for r in rows if r["item_id"] == "a") == [1, 2, 3]
    assert search(no_documents, items).count() == 0 and search(odd, items.limit(0)).count() == 0
