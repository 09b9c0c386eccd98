"""The corpus pipeline: documents are filtered, deduplicated, decontaminated, masked and mixed.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import stored, table
from tillbook.llm.decontaminate import decontaminate
from tillbook.llm.mix import mix
from tillbook.llm.neardup import drop_near_duplicates
from tillbook.llm.pii import mask_personal_data, train_spans
from tillbook.llm.quality import score_quality, train_quality


def _packed(docs: DataFrame) -> DataFrame:
    """Each row as one struct beside its text, so that no column of it gives way to a result of the same name."""
    return docs.select(F.struct("*").alias("whole"), F.col("text"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from all labelled ones, does not reject.

    Every column is kept as it is. A null or empty text is scored as one without words; repeated rows share
    their score; an empty table stays empty. Without labels of both classes, the share of the labels decides.
    """
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(_packed(docs), model, keep=["whole"]).where("predicted = 1").select("whole.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id.

    Every column is kept as it is. Documents without a shingle are no near duplicates of others; of rows that tie
    in their id one stays; an empty table stays empty.
    """
    return drop_near_duplicates(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark windows.

    Every column is kept as it is. A null or empty text has no words and stays; repeated rows go or stay
    together; with an empty benchmark all stay.
    """
    marked = decontaminate(_packed(docs), table(spark, sf_dir, "benchmark"), keep=["whole"])
    return marked.where("NOT contaminated").select("whole.*")


def mask_people(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; n_chars is counted again.

    Every other column is kept as it is. A null text stays null, an empty one empty; of spans that overlap
    the first names the kind; an empty table stays empty.
    """
    return mask_personal_data(docs, train_spans(docs), n_chars="n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes from each.

    A null or empty text has size 0 and takes none; a null source is a source of its own; repeated rows are
    documents each. Columns named like a result give way to it, as the mix is the last stage.
    """
    return mix(docs)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("near-duplicates", drop_copies),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", mask_people),
    ("source mix", mix_sources),
]

#: SQL cannot express trained classifiers and signatures; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
