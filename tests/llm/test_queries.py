"""The registered queries against their SQL, and the pipeline."""

import pytest
from compare import duck, duck_rows, spark_rows
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from tillbook.llm.oracle import ORACLE_SQL
from tillbook.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    names, rows = spark_rows(QUERIES[name](spark, SMALL))
    expected_names, expected = duck_rows(duck(SMALL), ORACLE_SQL[name])
    assert names == expected_names and rows == expected


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_every_document_or_page_has_a_row(spark):
    counts = {t: spark.read.parquet(f"{SMALL}/{t}.parquet").count() for t in ("documents", "pages")}
    for name in ("op1_decontaminate", "op4_pii", "op5_near_duplicates", "op7_language", "op8_quality", "op9_mix"):
        assert QUERIES[name](spark, SMALL).count() == counts["documents"], name
    assert QUERIES["op6_html"](spark, SMALL).count() == counts["pages"]
    assert QUERIES["op3_token_counts"](spark, SMALL).select("doc_id").distinct().count() == counts["documents"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SMALL)
        assert docs.columns == before.columns, name
    kept = docs.count()
    assert 0 < kept < n
    assert corpus_pipeline.run(spark, SMALL).count() == kept


def test_pipeline_over_odd_documents(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() > 0
    empty = odd.limit(0).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0


def test_pipeline_stages_keep_columns_named_like_results(spark):
    """Columns that the operators make themselves hold what the caller put there, after every stage that keeps columns."""
    names = ("score", "predicted", "n_words", "n_hit", "n_items", "items", "contaminated", "row", "whole", "text key", "node", "found", "marks", "statistics")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    named = docs.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, named = named.columns, stage(spark, named, SMALL)
        assert named.columns == before, name
        wrong = [F.col(f"`{c}`") != F.concat(F.lit(f"{c}-"), "doc_id") for c in names]
        count = named.count()
        assert count > 0 and named.where(F.coalesce(*[F.when(w, True) for w in wrong])).count() == 0, name
