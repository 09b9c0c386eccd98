"""The registered queries of the operators, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import stored, table
from tillbook.llm.decontaminate import decontaminate
from tillbook.llm.html import extract_text
from tillbook.llm.language import detect_language, train_languages
from tillbook.llm.lexical import search
from tillbook.llm.mix import mix
from tillbook.llm.nearest import build_index, nearest
from tillbook.llm.neardup import near_duplicates
from tillbook.llm.outliers import estimate, judge
from tillbook.llm.periodic import collapse_runs, repeat_words
from tillbook.llm.pii import KINDS, digest, find_personal_data, train_spans
from tillbook.llm.quality import score_quality, train_quality
from tillbook.llm.secrets import count_words, find_candidates, remove_false_positives
from tillbook.llm.textrules import COUNTS, with_counts
from tillbook.llm.tokens import count_tokens, section_rows

Query = Callable[[SparkSession, str], DataFrame]


def held_out(parts: int, part: int) -> Column:
    """Whether a document is kept from training: by the checksum of its id; false for a null id."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % parts == part, F.lit(False))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark in every document."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate(docs, benchmark, keep=["doc_id"]).drop("items")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates for secrets in every document with the forest's verdict.

    The findings it learns from are labelled by unmistakable marks (the others have no label) and come from documents whose
    crc32(doc_id as text) mod 5 is not 0; the rest is held out.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = find_candidates(docs, count_words(docs)).withColumn("held_out", held_out(5, 0))
    scored = remove_false_positives(found, found.where("NOT held_out"))
    return scored.select("doc_id", "begin", "end", "label", "held_out", F.round("score", 9).alias("score"), "secret")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token that crosses a border goes to where it begins."""
    counted = count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"], rule="first")
    return section_rows(counted).withColumn("tokens", F.col("tokens").cast("long"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document; counts and base_sha256 are of the base spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs, train_spans(docs), keep=["doc_id"])
    base = F.filter("found", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(digest(F.col("found"), True), 256).alias("base_sha256"),
        digest(F.col("found"), False).alias("spans"),
        F.filter("found", lambda s: ~s["base"]).alias("added"),
    )


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    trees = train_languages(docs.where(~held_out(4, 2)))
    return detect_language(docs, trees, keep=["doc_id"]).withColumn("held_out", held_out(4, 2))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train_quality(docs.where(~held_out(5, 0)), table(spark, sf_dir, "labels"))
    return score_quality(docs, model, keep=["doc_id"]).withColumn("held_out", held_out(5, 0))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    return mix(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings for every twentieth one."""
    index, space = build_index(table(spark, sf_dir, "embeddings"))
    return nearest(index, space, F.col("vec_id") % 20 == 0)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, after a period was planted in about one of ten."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeat_words(F.col("text"), F.col("doc_id")).alias("text"))
    found = collapse_runs(docs, keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])))
    length = -longest["less"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"), length.alias("length"), longest["period"].alias("period"),
        F.floor(1000 * length / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics of every document, and whether it is an outlier of its language and source."""
    counted = stored(with_counts(table(spark, sf_dir, "documents"), "text", ["doc_id", "lang", "source"]), "outlier-counts")
    return judge(counted, estimate(counted)).select("doc_id", *COUNTS, "base_failed", "kept", F.round("distance", 6).alias("distance"))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_secrets": op2_secrets,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_html": op6_html,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_mix": op9_mix,
    "op10_nearest": op10_nearest,
    "op11_ranked_search": op11_ranked_search,
    "op12_runs": op12_runs,
    "op13_outliers": op13_outliers,
}
