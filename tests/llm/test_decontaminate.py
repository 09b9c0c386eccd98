import hashlib
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from test_words import words_of

from tillbook.llm.common import Words
from tillbook.llm.decontaminate import WINDOW, decontaminate, item_windows, rarest_prefixes


def brute(docs, items):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated) by comparing every window everywhere."""
    windows = []
    for item, text in items:
        w = words_of(text)
        n = min(WINDOW, len(w))
        windows += [("" if item is None else str(item), w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def sample(seed=1):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünder", "CamelCase"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 4, 5, 6, 12, 13, 14, 20, 30, 45])]
    items += [(3, "other words, same id " * 3), (None, text(15)), (50, None), (51, ""), (52, "..."), (8, items[8][1])]
    docs = [(i, text(rng.integers(0, 80))) for i in range(40)] + [(None, None), (40, ""), (41, "a" * 100_000)]
    for i, (_, t) in enumerate(items[4:13]):
        docs += [(100 + i, f"{text(200)}! {t.upper()}; {text(3)}"), (100 + i, t), (200 + i, " ".join(words_of(t)[:-1]) + " x")]
    return docs, items


def result(frame):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=str)


def test_same_as_brute_force(spark):
    docs, items = sample()
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate(d, b)) == brute(docs, items)


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items = sample(2)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert result(decontaminate(d, b, block_bytes=200)) == brute(docs, items)


def test_odd_documents(spark, odd, no_documents):
    items = spark.createDataFrame([("x", "beta gamma DELTA"), ("y", "one two")], "item_id string, text string")
    found = decontaminate(odd.withColumnRenamed("label", "n_hit"), items)
    assert found.count() == odd.count() and found.columns[-1] == "items" and found.columns.count("n_hit") == 1
    assert {r["doc_id"] for r in found.where("contaminated").collect()} == {1, 2, None, 8}
    assert decontaminate(no_documents, items).count() == 0
    none = decontaminate(odd, items.limit(0))
    assert none.count() == odd.count() and none.where("n_hit > 0 OR contaminated").count() == 0


def test_windows_are_those_of_plain_python():
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "Bb", "ü", "c3"], rng.integers(0, 40))) for _ in range(60)] + [None, "", "..", "x" * 5000, "q w e r t"]
    names = [str(i % 50) for i in range(len(texts))]
    expected = {}
    for name, text in zip(names, texts, strict=True):
        words = words_of(text)
        n = min(WINDOW, len(words))
        for i in range(len(words) - n + 1) if n else ():
            expected.setdefault(" ".join(words[i : i + n]).encode(), set()).add(name)
    found = item_windows(pa.array(names), pa.array(texts))
    got = {found.text(w): {found.names[i] for i in found.item[found.first[w] : found.first[w + 1]]} for w in range(found.at.size)}
    assert got == expected and found.at.size == len(expected)


def test_hash_collisions_keep_windows_apart(monkeypatch):
    """With every hash the same, windows are still told apart by their words."""
    windows = Words.windows
    monkeypatch.setattr(Words, "windows", lambda self, n: (lambda at, value: (at, value * np.uint64(0) + np.uint64(7)))(*windows(self, n)))
    found = item_windows(pa.array(["a", "b", "c"]), pa.array(["one two", "one three", "one two"]))
    got = [(found.text(w), sorted(found.names[i] for i in found.item[found.first[w] : found.first[w + 1]])) for w in range(found.at.size)]
    assert (b"one three", ["b"]) in got and {t for t, _ in got} == {b"one two", b"one three"}


def test_a_block_of_16_mb_takes_bounded_memory():
    rng = np.random.default_rng(6)
    words = np.array([f"{a}{i}" for i in range(3000) for a in ("wo", "rdly", "x")])
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60_000)]
    ids, texts = pa.array([str(i) for i in range(len(texts))]), pa.array(texts)
    assert 15 << 20 < texts.nbytes < 18 << 20
    tracemalloc.start()
    started = time.time()
    block = item_windows(ids, texts)
    keys = np.unique(block.shingle)
    prefixes = rarest_prefixes(block, keys, np.ones(keys.size, dtype=np.int64))
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 500e6 and time.time() - started < 60
    assert held < 300e6 and prefixes.windows.size > 1_000_000


def test_one_block_takes_one_python_worker(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "other words")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "b c d")], "item_id string, text string")
    found = decontaminate(docs, items)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r.n_hit, r.n_items, r["items"], r.contaminated) for r in found.orderBy("doc_id").collect()] == [(3, 1, ["i"], True), (0, 0, [], False)]
