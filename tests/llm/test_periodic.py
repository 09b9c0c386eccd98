import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbook.llm.lyndon import lyndon_groups, runs
from tillbook.llm.periodic import collapse_runs, find_runs, repeat_words
from tillbook.llm.plainwords import PlainWords


def lyndon_array(s):
    """By definition: the longest Lyndon word from a place ends where a smaller suffix begins."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def all_runs(s, copies, least):
    found = set()
    for p in range(1, len(s)):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j > i and j - i + p >= max(copies * p, least):
                found.add((i, j - i + p, p))
            i = j + 1
    inside = lambda r, o: o[2] < r[2] and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1]
    return sorted(r for r in found if not any(inside(r, o) for o in found))


def sequences(n, seed):
    rng = random.Random(seed)
    for t in range(n):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(0, 40))]
        if t % 2:
            p = rng.randint(1, 6)
            s = [s[i % p] if 3 < i < len(s) - 3 else s[i] for i in range(len(s))]
        yield s


def test_lyndon_arrays_and_groups():
    for s in sequences(500, 1):
        values = sorted(set(s))
        ranks = [values.index(v) for v in s]
        length, group = lyndon_groups(ranks, len(values))
        assert length.tolist() == lyndon_array(ranks)
        words = [tuple(ranks[i : i + n]) for i, n in enumerate(length)]
        assert all((group[i] == group[j]) == (words[i] == words[j]) for i in range(len(s)) for j in range(i))


@pytest.mark.parametrize("copies, least", [(2, 0), (3, 4), (4, 6), (5, 8)])
def test_runs_equal_brute_force(copies, least):
    for s in sequences(400, copies):
        assert runs(np.array(s, dtype=np.int64), copies, least) == all_runs(s, copies, least)


@pytest.mark.parametrize("copies, least", [(3, 4), (4, 6), (5, 8)])
def test_no_run_is_lost_between_stretches(copies, least):
    texts = [[f"w{x}" for x in s] for s in sequences(300, 7 * copies)]
    words = PlainWords(pa.array(["  ".join(t) for t in texts]))
    expected = [(int(words.first[i]) + a, n, p) for i, t in enumerate(texts) for a, n, p in all_runs(t, copies, least)]
    assert [tuple(r) for r in find_runs(words, copies, least).tolist()] == expected


def test_long_texts_take_linear_time():
    rng = random.Random(3)
    started = time.time()
    for n, symbol in ((200_000, lambda i: i % 50_000), (200_000, lambda i: 0), (200_000, lambda i: rng.randrange(3)), (200_000, lambda i: i % 6 // 5)):
        runs(np.array([symbol(i) for i in range(n)]), 4, 6)
    assert time.time() - started < 60


def test_collapsed_text_keeps_the_first_period(spark):
    texts = ["x a b a b a b a b y", "  a a\ta a\na a  ", "é é é é é é", "no run here", "", None, "a a a a a", "p q p q p q p q r r r r r r"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rows = {r["id"]: r for r in collapse_runs(docs, keep=["id"]).collect()}
    assert [rows[i]["collapsed"] for i in range(8)] == ["x a b y", "a", "é", "no run here", "", "", "a a a a a", "p q r"]
    assert [(r["start"], r["length"], r["period"]) for r in rows[7]["runs"]] == [(0, 8, 2), (8, 6, 1)]
    assert rows[5]["n_words"] == 0 and rows[5]["runs"] == []


def test_planted_periods(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(400)] + [(None, "a b")], "doc_id long, text string")
    for row in docs.select("doc_id", "text", repeat_words(F.col("text"), F.col("doc_id")).alias("out")).collect():
        words = row["text"].split()
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        g = h // 10
        if row["doc_id"] is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        assert row["out"].split() == words


def test_odd_documents(spark, odd, no_documents):
    found = collapse_runs(odd)
    assert found.count() == odd.count() and set(odd.columns) <= set(found.columns)
    assert found.where("runs IS NULL OR collapsed IS NULL OR n_words IS NULL").count() == 0
    assert collapse_runs(odd.withColumn("runs", F.lit(1))).columns.count("runs") == 1
    assert collapse_runs(no_documents).count() == 0
    with pytest.raises(ValueError):
        collapse_runs(odd, copies=2)
