import pytest

SMALL = "/root/testdata/sf0.001"

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, row string, node string, "
    "taken long, found string, label int, `text key` string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty and very long texts, repeated rows and clashing columns."""
    words = " ".join(f"w{i % 977}" for i in range(60_000))
    one = "alpha beta gamma delta epsilon zeta eta theta"
    texts = [
        (1, one, "en"), (1, one, "en"), (2, one, None), (3, None, "en"), (None, one + " iota", "fr"), (4, "", "en"),
        (5, words, "fr"), (6, "a" * 300_000, "en"), (7, "!!! ???", None), (8, "one two", "en"), (8, "one two", "en"),
        (None, None, None), (9, "ééé ñ 漢字 \U0001f600 " * 50, "de"), (10, "\n\n \t\n", "de"),
    ]
    rows = [(i, t, lang, None if i == 2 else "s1", len(t) if t else None, 0.5, "r", "n", 1, "f", 1, "k") for i, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
