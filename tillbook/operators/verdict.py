"""File-level outcome of an ingest: what was loaded, what was rejected and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.schema import INGEST_LOG_SCHEMA

# Longest message per event, and the stamp before a filed name.
FAILURE_CHARS, CORRUPTED_CHARS = 600, 400
STAMP_FORMAT = "yyyyMMdd_HHmmss"

EVENT_COLUMNS = tuple(c for c in INGEST_LOG_SCHEMA.fieldNames() if c not in ("batch_id", "stage"))

NO_ROWS = "The sheet has headers only."
NONE_VALID = "Each row lacks a date, a customer or an amount."


def count_rows(rows: DataFrame, name: str) -> DataFrame:
    """Rows per file, pre-aggregated before the shuffle."""
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias(name))


def file_report(planned: DataFrame, kept_counts: DataFrame) -> DataFrame:
    """One row per file with its counts and the reason of its rejection, if any.

    ``planned`` has ``rows_read``, ``kept_counts`` the rows kept per path. Starts from the
    files, so that one without any row is still reported.
    """
    counted = planned.join(kept_counts, "path", "left")
    read = F.coalesce("rows_read", F.lit(0).cast("bigint"))
    kept = F.coalesce("rows_kept", F.lit(0).cast("bigint"))
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(read == 0, F.lit(NO_ROWS))
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(kept == 0, F.lit(NONE_VALID))
    )
    usable = F.col("problem").isNull()
    return counted.select(
        *[c for c in ("path", "modified_at", "seconds") if c in planned.columns],
        "source_file",
        "columns_read",
        read.alias("rows_read"),
        F.when(usable, kept).otherwise(0).alias("rows_loaded"),
        F.when(usable, read - kept).otherwise(0).alias("rows_dropped"),
        reason.alias("reason"),
    )


def rejected_rows(raw_rows: DataFrame, report: DataFrame) -> DataFrame:
    """Raw rows of the rejected files with the reason."""
    bad = report.filter("reason IS NOT NULL").select("path", "reason")
    return raw_rows.join(bad, "path").select("path", "source_file", "row_no", "cells", "reason")


def filed_name(stamp: Column, source_file: Column) -> Column:
    """Name under which a finished file is put away."""
    return F.concat_ws("_", F.date_format(stamp, STAMP_FORMAT), source_file)


def detected_events(files: DataFrame, logged_at: Column) -> DataFrame:
    """Ingest log: one ``detected`` event per file, written before anything is read from it."""
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in INGEST_LOG_SCHEMA}
    known = {
        "source_file": F.element_at(F.split("path", "/"), -1), "path": F.col("path"), "modified_at": F.col("modificationTime"),
        "event": F.lit("detected"), "logged_at": logged_at,
    }
    return files.select(*[known.get(c, unknown[c]).alias(c) for c in EVENT_COLUMNS])


def outcome_events(report: DataFrame, logged_at: Column) -> DataFrame:
    """Ingest log: ``success``, or ``failure`` and ``corrupted``, with what became of the file."""
    ok = F.col("reason").isNull()
    events = F.when(ok, F.array(F.lit("success"))).otherwise(F.array(F.lit("failure"), F.lit("corrupted")))
    known = {
        "message": F.when(F.col("event") == "failure", F.substring("reason", 1, FAILURE_CHARS))
        .when(F.col("event") == "corrupted", F.substring("reason", 1, CORRUPTED_CHARS)),
        "disposition": F.when(ok, "processed").otherwise("failed"),
        "target_name": filed_name(logged_at, F.col("source_file")),
        "logged_at": logged_at,
    }
    per_event = report.withColumn("event", F.explode(events))
    return per_event.select(*[known.get(c, F.col(c)).alias(c) for c in EVENT_COLUMNS])


def postponed_events(put_off: DataFrame, logged_at: Column) -> DataFrame:
    """Ingest log: one ``postponed`` event per file that the storage did not give, and that is tried again."""
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in INGEST_LOG_SCHEMA}
    known = {
        "source_file": F.element_at(F.split("path", "/"), -1), "path": F.col("path"), "modified_at": F.col("modified_at"),
        "event": F.lit("postponed"), "message": F.substring("reason", 1, FAILURE_CHARS), "logged_at": logged_at,
    }
    return put_off.select(*[known.get(c, unknown[c]).alias(c) for c in EVENT_COLUMNS])
