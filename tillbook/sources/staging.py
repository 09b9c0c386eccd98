"""The sales table: append, read, and SQL access."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.schema import STAGING_SCHEMA, STORED_SCHEMA
from tillbook.sources.clustering import along_curve
from tillbook.sources.settings import FREE_SHUFFLES, settings


def _batch_path(table: str, batch_id: str) -> str:
    return f"{table}/batch_id={batch_id}"


def append_sales(rows: DataFrame, table: str, batch_id: str, cluster_by: Sequence[str] = ()) -> int:
    """Write one batch into the table at path ``table`` and return its row count.

    Columns are matched by name; a missing ``loaded_at`` becomes the time of the
    load, a missing ``path`` is NULL. The batch has a folder of its own, so writing the same ``batch_id``
    again replaces it and a repeated batch never doubles rows. Rows are
    rebalanced by month to get few files, with large months split by adaptive
    execution, and sorted to make row-group statistics selective. ``cluster_by`` orders the rows of a month along a
    curve through these columns instead; the rows are then read once more, to count their values.
    """
    if "loaded_at" not in rows.columns:
        rows = rows.withColumn("loaded_at", F.current_timestamp())
    if "path" not in rows.columns:
        rows = rows.withColumn("path", F.lit(None).cast("string"))
    month = F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit("none"))
    dated = rows.select(*STORED_SCHEMA.fieldNames(), month.alias("sale_month"))
    if cluster_by:
        ordered = along_curve(dated, cluster_by)
    else:
        ordered = dated.hint("rebalance", F.col("sale_month")).sortWithinPartitions("sale_month", "region", "city")
    with settings(rows.sparkSession, FREE_SHUFFLES):
        (
            ordered.write.mode("overwrite")
            # Equality filters on these columns, by which rows aren't sorted, skip row groups.
            .option("parquet.bloom.filter.enabled#customer_name", "true")
            .option("parquet.bloom.filter.enabled#source_file", "true")
            .partitionBy("sale_month")
            .parquet(_batch_path(table, batch_id))
        )
    return read_batch(rows.sparkSession, table, batch_id).count()


def read_batch(spark: SparkSession, table: str, batch_id: str) -> DataFrame:
    """The rows of one batch; lists the folder of that batch only."""
    return spark.read.schema(STORED_SCHEMA).parquet(_batch_path(table, batch_id))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table, or an empty one of the same schema if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_sales(spark: SparkSession, table: str, commits: DataFrame | None = None) -> DataFrame:
    """All sales of the table at path ``table``; with ``commits``, those of complete batches.

    The commits are one small row per batch: Spark broadcasts them by their known
    size and reads the folders of those batches only.
    """
    sales = read_table(spark, table, STAGING_SCHEMA)
    if commits is None:
        return sales
    return sales.join(commits.select("batch_id"), "batch_id", "left_semi").select(*sales.columns)


def query(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Run SQL over the registered views, with named parameters."""
    return spark.sql(sql, args=args)


def query_scalar(spark: SparkSession, sql: str, args: dict | None = None):
    """First column of the first row, or None without a row."""
    row = query(spark, sql, args).first()
    return row[0] if row else None
