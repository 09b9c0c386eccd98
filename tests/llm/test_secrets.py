import itertools
import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbook.llm.queries import op2_secrets
from tillbook.llm.secrets import LEAST_LENGTH, Language, candidate_spans, count_words, features, find_candidates, known_label, remove_false_positives


def test_candidates_are_those_of_the_pattern():
    texts = ["é token = \"abcDEF0123456789xyz\", a/b-c_d+e0123456789", None, "", "short1", "x" * 40, "1" * 40 + " " + "9" * LEAST_LENGTH]
    expected = [
        [m.span() for m in re.finditer(rf"[A-Za-z0-9+/_-]{{{LEAST_LENGTH},}}", t or "") if re.search("[0-9]", m[0])] for t in texts
    ]
    assert candidate_spans(pa.array(texts, pa.string())) == expected


WEB_TOKEN = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOjF9.dBjftJeZ-4_x"


@pytest.mark.parametrize("text, values", [
    ("password=hunter2x9", ["hunter2x9"]), ("é pwd: s3c!", ["s3c!"]), ("secret = 'correct horse battery'", ["correct horse battery"]),
    ('{"api_key": "QwErTyUiOp", "n": 1}', ["QwErTyUiOp"]), ("Authorization: Bearer abc.def~ghi+j==", ["abc.def~ghi+j=="]),
    (f"see {WEB_TOKEN}, then", [WEB_TOKEN]), ("passwd=pa$$w.rd@home!%~,x", ["pa$$w.rd@home!%~"]), ("x --token Zq9.Lm2!k y", ["Zq9.Lm2!k"]),
    ("db = p4ss.w0rd!", ["p4ss.w0rd!"]), ("session: QwErTyUiOp.", ["QwErTyUiOp"]), ("cmd: 'login token=a1b2c3 now'", ["a1b2c3"]),
    ("signing_key=zz9", ["zz9"]), ("key = abcdef", ["abcdef"]), ("private key abcdEFGH1234", ["abcdEFGH1234"]), ("monkey = abc", []),
    ("cookie: a=b", ["a=b"]), ("user=u&token=Ab:cd=ef9&x=1", ["Ab:cd=ef9"]), ("at 12:30 a: b, no value = 1", []), ("password:\nnext", []), ("tokens and passwords", []),
])
def test_short_values_and_values_with_signs_are_candidates(text, values):
    assert [text[b:e] for b, e in candidate_spans(pa.array([text]))[0]] == values


ISSUED = "ghp_" + "a1B2" * 9


@pytest.mark.parametrize("text, labels", [
    ('{"api_key": "a1b2c3d4e5f6a7b8"}', [1]), ("'token': 'a1b2c3d4e5f6a7b8'", [1]), ("Authorization: Bearer a1b2c3d4e5f6a7b8", [1]),
    (f"https://host/{ISSUED}", [1]), (f"https://host.org/a/x-{ISSUED}/b", [1]), (f"see {WEB_TOKEN}", [1]), ("password=hunter2x9", [1]),
    ("password: changes", [None]), ("key a1b2c3d4e5f6a7b8c9", [None]), ("the token is x, a1b2c3d4e5f6a7b8c9", [None]),
    ("commit a1b2c3d4e5f6a7b8c9d0", [0]), ("card 4952935900253052", [0]), ("kind: wordwords", [0]), ("kind: xkQzvbnm", [None]),
    ("x 6fa459ea-ee8a-3ca4-894e-db77e160355e", [0]), (f"x{ISSUED}", [None]),
])
def test_labels_are_by_clear_marks_only(text, labels):
    language = Language({"word": 1, "words": 1}, {})
    assert [known_label(text, b, e, language) for b, e in candidate_spans(pa.array([text]))[0]] == labels


def test_findings_without_label_teach_nothing(spark):
    rows = [(1, [1.0, 0.0]), (0, [0.0, 1.0]), (None, [1.0, 0.0])] * 20
    found = spark.createDataFrame(rows, "label int, features array<double>")
    scored = remove_false_positives(found, found)
    assert {(r["label"], r["secret"]) for r in scored.collect()} == {(1, True), (0, False), (None, True)}
    assert {r["score"] for r in remove_false_positives(found, found.where("label IS NULL OR label = 0")).collect()} == {1 / 22}


def test_candidates_take_linear_time():
    for unit in ("token=", "=:", "a=", ":'", 'a="', "token ", "eyJ", "eyJabcde.", "password: '", "= "):
        candidate_spans(pa.array([unit * 50_000, (unit * 50_000).upper()]))


def test_held_out_findings(spark):
    found = op2_secrets(spark, "/root/testdata/sf0.1").where("held_out")
    row = found.agg(F.count(F.lit(1)), F.sum("label"), F.avg((F.col("label") == F.col("secret").cast("int")).cast("int"))).first()
    assert row[0] >= 50 and row[1] >= 20 and row[2] >= 0.97


def plain_counts(texts, rarity):
    """Words and pairs by plain counting."""
    words = Counter(w for t in texts for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    words = Counter({w: n for w, n in words.items() if 3 <= len(w) <= 12 and not re.search("[0-9]", w)})
    pairs = Counter()
    for w, n in words.items():
        for i in range(len(w) - 1):
            pairs[w[i : i + 2]] += n
    return tuple({k: n for k, n in c.items() if n * rarity >= sum(c.values())} for c in (words, pairs))


def test_word_counts(spark, odd):
    docs = odd.union(odd.where("doc_id = 9")).unionByName(odd.limit(0))
    texts = [r["text"] for r in docs.select("text").collect()]
    for rarity in (10, 30, 200_000):
        assert count_words(docs, rarity=rarity) == plain_counts(texts, rarity)
    assert count_words(odd)[0]["alpha"] == 4 and "éééé" not in count_words(odd)[0] and count_words(odd)[0]["ééé"] == 50
    assert count_words(odd.limit(0)) == ({}, {})
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert count_words(given) == plain_counts([r["text"] for r in given.select("text").collect()], 200_000)


def test_language():
    language = Language({"alpha": 3, "beta": 1, "alph": 1, "the": 9}, {"al": 4, "lp": 4, "ph": 4, "ha": 3, "be": 1, "et": 1, "ta": 1})
    assert language.coverage("alphabeta7") == 0.9 and language.coverage("x7x7") == 0.0 and language.coverage("thethe1") == 6 / 7
    assert language.surprise("alpha") < language.surprise("xq7z9")


def plain_coverage(value, words):
    low, at, covered = value.lower(), 0, 0
    while at < len(low):
        fits = [w for w in words if low.startswith(w, at)]
        covered += max(map(len, fits), default=0)
        at += max(map(len, fits), default=1)
    return covered / len(low)


def test_features_against_plain_ones():
    chance = random.Random(5)
    words = {"".join(chance.choices("abé", k=chance.randint(3, 6))) for _ in range(40)}
    language = Language(dict.fromkeys(words, 1), {"ab": 3, "ba": 2})
    for _ in range(200):
        value = "".join(chance.choices("abéAB1-", k=chance.randint(1, 30)))
        got = features(f"my key = {value} of", 9, 9 + len(value), "a/b", language)
        kinds = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o" for c in value]
        assert got[0] == len(value) and got[1] == sum(x != y for x, y in itertools.pairwise(kinds)) / max(len(value) - 1, 1)
        assert got[2:6] == [kinds.count(k) / len(value) for k in "dluo"]
        bits = [{"ab": -math.log2(4 / 67), "ba": -math.log2(3 / 66)}.get(value[i : i + 2].lower(), 12.0) for i in range(len(value) - 1)]
        assert got[8] == pytest.approx(sum(bits) / max(len(bits), 1)) and got[9] == pytest.approx(plain_coverage(value, words))


def test_forest_does_not_depend_on_the_layout(spark):
    chance = random.Random(3)
    rows = [(int(x + chance.random() > 1), [x, chance.random(), float(i % 3)]) for i, x in enumerate([chance.random() for _ in range(400)])]
    found = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, label int, features array<double>")
    one, two = (remove_false_positives(found, found.repartition(n, "i")).orderBy("i").select("score").collect() for n in (1, 7))
    assert one == two


def test_odd_documents(spark, odd, no_documents):
    rows = [(1, "password=a1b2c3d4e5f6a7b8c9", None), (2, "ordinary-words-with-2-dashes", "p"), (2, "ordinary-words-with-2-dashes", "p")]
    docs = odd.select("doc_id", "text", "source").union(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    found = find_candidates(docs.withColumn("score", F.lit(1)), count_words(docs), keep=["doc_id", "score"])
    assert sorted(r["label"] for r in found.where("doc_id IN (1, 2)").collect()) == [0, 0, 1]
    scored = remove_false_positives(found, found)
    assert scored.count() == found.count() and scored.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert {r["score"] for r in remove_false_positives(found, found.where("label = 0")).collect()} == {1 / (2 + found.where("label = 0").count())}
    empty = find_candidates(no_documents, ({}, {}))
    assert remove_false_positives(empty, empty).count() == 0
