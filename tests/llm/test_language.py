import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillbook.llm.language import build_trees, detect_language, train_languages
from tillbook.llm.queries import held_out


def brute_bits(training, text):
    """Code length of a text by walking the contexts one byte at a time."""
    counts = {}
    for t in training:
        data = b"\n\n\n" + t.encode()
        for i in range(3, len(data)):
            for order in range(4):
                own = counts.setdefault(data[i - order : i], {})
                own[data[i]] = own.get(data[i], 0) + 1
    total, data = 0.0, b"\n\n\n" + text.encode()
    for i in range(3, len(data)):
        for order in (3, 2, 1, 0):
            own = counts.get(data[i - order : i])
            if own is None:
                continue
            whole = sum(own.values()) + len(own)
            if data[i] in own:
                total -= np.log2(own[data[i]] / whole)
                break
            total -= np.log2(len(own) / whole)
        else:
            total += 8
    return total


def grams(training):
    out = {}
    for t in training:
        data = b"\n\n\n" + t.encode()
        for i in range(3, len(data)):
            key = int.from_bytes(data[i - 3 : i + 1], "big")
            out[key] = out.get(key, 0) + 1
    return out


def test_code_lengths_are_exact():
    training = [["the cat sat on the mat", "a hat"], ["le chat était là", "où?"]]
    tables = [grams(t) for t in training]
    language = np.concatenate([np.full(len(t), k) for k, t in enumerate(tables)])
    keys = np.array([g for t in tables for g in t], dtype=np.uint64)
    counts = np.array([n for t in tables for n in t.values()])
    trees = build_trees(["en", "fr"], language, keys, counts)
    texts = ["the mat", "chat", "zz top \U0001f600", "", "t", "où est le chat", None]
    bits = trees.lengths(pa.array(texts, pa.string()))
    for k in (0, 1):
        expected = [brute_bits(training[k], t or "") for t in texts]
        assert np.allclose(bits[:, k], expected, rtol=1e-5, atol=1e-4)


def test_many_languages_keep_all_contexts():
    training = [[f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(0x3b1 + k % 20)} the cat {k} sat on mat {k * 7919}"] for k in range(300)]
    tables = [grams(t) for t in training]
    language = np.concatenate([np.full(len(t), k) for k, t in enumerate(tables)])
    keys = np.array([g for t in tables for g in t], dtype=np.uint64)
    counts = np.array([n for t in tables for n in t.values()])
    texts = ["the mat", training[7][0], training[299][0], "zz top"]
    expected = np.array([[brute_bits(own, t) for own in training] for t in texts])
    for cells in (24_000_000, 1, 0):
        bits = build_trees([str(k) for k in range(300)], language, keys, counts, cells).lengths(pa.array(texts))
        assert np.allclose(bits, expected, rtol=1e-5, atol=1e-4)


def test_every_language_has_a_tree(spark):
    rows = [(f"{chr(0x4e00 + 3 * k)}{chr(0x4e01 + 3 * k)} " * 20, f"l{k:03}") for k in range(230)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for train_bytes in (8 << 20, 1):  # at 1, only the text of each language that comes first is drawn
        trees = train_languages(docs, train_bytes=train_bytes)
        assert len(trees.languages) == 230
        assert detect_language(docs, trees).where("lang = lang_pred").count() == 230


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees = train_languages(docs.where(~held_out(4, 2)))
    found = detect_language(docs, trees).where(held_out(4, 2))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert right[1] > 100 and right[0] >= 0.97


def test_few_cells_leave_shorter_contexts(spark):
    docs = spark.createDataFrame([("the cat sat on the mat " * 20, "en"), ("le chat était là " * 20, "fr")], "text string, lang string")
    trees = train_languages(docs, cells=20_000)
    assert [r["lang_pred"] for r in detect_language(docs, trees).collect()] == ["en", "fr"]


def test_odd_documents(odd, no_documents):
    trees = train_languages(odd)
    found = detect_language(odd, trees)
    assert found.count() == odd.count() and found.columns.count("score") == 1
    und = {r["doc_id"] for r in found.where("lang_pred = 'und' AND score = 0").collect()}
    assert und == {3, 4, 7, 10, None}
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert train_languages(no_documents) is None
    assert {r["lang_pred"] for r in detect_language(odd, None).collect()} == {"und"}
    assert detect_language(no_documents, trees).count() == 0
