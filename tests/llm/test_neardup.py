import collections

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_words import words_of

from tillbook.llm import neardup
from tillbook.llm.bagminhash import SLOTS, Bags, bags_of, overlap, signatures
from tillbook.llm.common import Words
from tillbook.llm.components import components
from tillbook.llm.neardup import drop_near_duplicates, near_duplicates


def bag(text):
    w = words_of(text)
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def classes(docs):
    """Sets of the ids of connected documents, by comparing all pairs."""
    bags = [bag(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(bags):
        for j, b in enumerate(bags[:i]):
            if a and b:
                both = sum((a & b).values())
                if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
                    root[find(i)] = find(j)
    out = collections.defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        out[find(i)].append(doc)
    return sorted(sorted(v) for v in out.values())


def family(seed, n):
    """Unrelated texts, copies, and copies with one to many changes."""
    rng = np.random.default_rng(seed)
    word = lambda: f"v{rng.integers(5000)}"
    docs = []
    for _ in range(n):
        base = [word() for _ in range(rng.integers(3, 150))]
        docs.append(" ".join(base))
        for _ in range(rng.integers(0, 12)):
            copy = list(base)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(len(copy))] = word()
            docs.append(" ".join(copy) + (" and so on" if rng.random() < 0.2 else ""))
    return list(enumerate(docs))


def grouped(frame):
    out = collections.defaultdict(list)
    for r in frame.collect():
        out[r["class_id"]].append(r["doc_id"])
    return sorted(sorted(v) for v in out.values())


@pytest.mark.parametrize(("block", "shingles"), [(1024, 1 << 20), (16, 1 << 20), (1024, 700)])
def test_same_classes_as_brute_force(spark, monkeypatch, block, shingles):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", shingles)
    docs = family(block, 40)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = near_duplicates(frame)
    assert grouped(found) == classes(docs)
    assert found.where("kept").count() == len(classes(docs))


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 4000)
    held = spark.sparkContext.accumulator(0)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(60):  # one family in many components: each text keeps about half of the words
        docs += [(i, " ".join(w if rng.random() < 0.98 else f"x{i}" for w in base))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    plain = neardup._links_across

    def counted(group):
        held.add(int(group["shingles"].map(len).sum() > 3 * 4000))
        return plain(group)

    monkeypatch.setattr(neardup, "_links_across", counted)
    assert grouped(near_duplicates(frame)) == classes(docs)
    assert held.value == 0


def test_texts_with_one_key_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(neardup, "text_key", lambda: F.lit(7).cast("long"))
    docs = family(2, 8)
    assert grouped(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == classes(docs)


def test_multiset_counts_matter(spark):
    line = "one two three four five six seven. "
    docs = [(1, line * 10), (2, line * 9), (3, line * 30)]
    assert classes(docs) == [[1, 2], [3]]
    assert grouped(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == [[1, 2], [3]]


def test_slots_agree_with_the_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(150):
        n = int(rng.integers(1, 300))
        shingles = np.sort(rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2))
        counts = rng.integers(1, 40, n)
        kept = rng.random(n) < rng.random()
        kept[0] = True
        other = np.maximum(counts[kept] + rng.integers(-5, 6, kept.sum()), 1)
        bags = Bags(np.array([0, n, n + kept.sum()]), np.concatenate([shingles, shingles[kept]]), np.concatenate([counts, other]))
        a, b = signatures(bags)
        both, either = overlap((shingles, counts), (shingles[kept], other))
        errors.append((a == b).mean() - both / either)
    assert abs(np.mean(errors)) < 4 * 0.5 / np.sqrt(SLOTS * 150)
    assert np.std(errors) < 0.05


def test_signature_depends_on_the_bag_alone():
    texts = ["a b c d e f g", "x", None, "h i j k l m n o p q", "a b c d e f g"]
    whole = signatures(bags_of(Words(pa.array(texts))))
    alone = [signatures(bags_of(Words(pa.array([t], pa.string()))))[0] for t in texts]
    assert (whole == np.array(alone)).all() and (whole[0] == whole[4]).all()


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    edges += [tuple(map(int, rng.integers(200, 300, 2))) for _ in range(60)]
    frame = spark.createDataFrame(edges, "a long, b long")
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {x: find(x) for x in root}
    assert components(frame.limit(0)).count() == 0


def test_odd_documents(odd, no_documents):
    found = near_duplicates(odd.withColumnRenamed("label", "kept"))
    assert found.count() == odd.count() and found.columns.count("kept") == 1
    assert found.where("class_id = 1").count() == 4  # the fourth is one word longer: four of five shingles
    assert found.where("class_id = 1 AND kept").count() == 1
    assert found.where("doc_id = 8").select("class_size").distinct().first()[0] == 2
    # Texts without words stay, each alone.
    assert found.where("doc_id IN (3, 4, 7, 10) AND kept AND class_size = 1").count() == 4
    rest = drop_near_duplicates(odd)
    assert rest.columns == odd.columns and rest.count() == found.where("kept").count()
    assert near_duplicates(no_documents).count() == 0
