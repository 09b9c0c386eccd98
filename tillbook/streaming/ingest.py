"""Load workbook folders into the sales table, as a batch job or as a stream.

Both ways call :func:`ingest_files` on a DataFrame of paths. A load first claims
its files in the store's ledger, so that no other load takes them, then writes to
folders that no other attempt writes to, and is committed last; only committed
batches are seen by readers. A load that stops gives its files back, or its claim
runs out. Files that the storage does not give are put off and tried again, by
whichever load comes next, and rejected after the last try only.
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillbook.operators.cleaning import CleaningOptions, add_date_mode, clean
from tillbook.operators.headers import DEFAULT_THRESHOLD, plan_files
from tillbook.operators.verdict import count_rows, detected_events, file_report, outcome_events, postponed_events, rejected_rows
from tillbook.package import ship_package
from tillbook.schema import CLAIMED_SCHEMA, FILES_SCHEMA, INGEST_LOG_SCHEMA, LANDING_SCHEMA, QUARANTINE_SCHEMA, RETRIES_SCHEMA
from tillbook.sources.folder import new_files, workbook_files
from tillbook.sources.ledger import Claim, Ledger, State
from tillbook.sources.settings import FREE_SHUFFLES, TWO_FOLDERS, listing, settings
from tillbook.sources.staging import append_sales, read_batch, read_sales, read_table
from tillbook.sources.workbook import Opener, raw_files, raw_rows, scan_workbooks, storage_failures

_BATCH_PREFIX = "batch-"

# How often a file is tried before it is given up, and the seconds between two tries.
TRIES, RETRY_SECONDS = 6, 2.0


@dataclass(frozen=True)
class SalesStore:
    """Where the tables live: one folder on storage that all executors share.

    ``lease_seconds``: for how long a load that has died keeps others from its files. ``compact_every``: ledger
    entries between two snapshots. ``opener``: opens a workbook in a task, for file systems that Arrow does not know.
    ``cluster_by``: columns along whose curve the rows of a batch are stored (see :func:`append_sales`).
    """

    root: str
    threshold: int = DEFAULT_THRESHOLD
    cleaning: CleaningOptions = field(default_factory=CleaningOptions)
    tries: int = TRIES
    retry_seconds: float = RETRY_SECONDS
    lease_seconds: float = 900.0
    compact_every: int = 100
    opener: Opener | None = None
    cluster_by: tuple[str, ...] = ()

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.path("ledger"))

    def sales(self, spark: SparkSession) -> DataFrame:
        """The rows of all committed batches."""
        return read_sales(spark, self.path("staging_sales"), self.commits(spark))

    def commits(self, spark: SparkSession) -> DataFrame:
        """The batches that are complete, one row each."""
        ledger = self.ledger(spark)
        return ledger.commits(ledger.state)

    def ingest_log(self, spark: SparkSession) -> DataFrame:
        """All events of committed batches, and the detection of files that no committed batch holds."""
        events = read_table(spark, self.path("ingest_log"), INGEST_LOG_SCHEMA)
        done = self.commits(spark).select("batch_id")
        committed = events.join(done, "batch_id", "left_semi").select(*events.columns)
        begun = events.filter("event = 'detected'").join(done, "batch_id", "left_anti")
        open_files = begun.join(committed.select("path", "modified_at").distinct(), ["path", "modified_at"], "left_anti")
        last = F.max(F.struct("logged_at", *[c for c in events.columns if c != "logged_at"])).alias("last")
        return committed.unionByName(open_files.groupBy("path", "modified_at").agg(last).select("last.*"))

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """The raw rows of rejected files, of committed batches."""
        rows = read_table(spark, self.path("quarantine"), QUARANTINE_SCHEMA)
        return rows.join(self.commits(spark).select("batch_id"), "batch_id", "left_semi").select(*rows.columns)


def _claimable(files: DataFrame, ledger: Ledger, state: State, batch_id: str) -> DataFrame:
    """The files, and those whose next try is due, that are neither done with nor held by another load."""
    known = files.select("path", F.col("modificationTime").alias("modified_at")).distinct().withColumn("attempt", F.lit(1))
    if ledger.has_retries(state):
        put_off = ledger.retries(state)
        now = F.timestamp_seconds(F.lit(time.time()))
        newer = known.select(F.col("path").alias("new_path"), F.col("modified_at").alias("new_time"))
        again = (F.col("path") == F.col("new_path")) & (F.col("modified_at") < F.col("new_time"))
        due = put_off.filter(F.col("due_at") <= now).join(newer, again, "left_anti")
        fresh = known.join(put_off.select("path", "modified_at"), ["path", "modified_at"], "left_anti")
        known = fresh.unionByName(due.select("path", "modified_at", (F.col("attempt") + 1).alias("attempt")))
    first, last = known.agg(F.min("modified_at"), F.max("modified_at")).first()
    # Of the files that are done with, only those as old as the new ones are read.
    done = ledger.loaded(state).filter(F.col("modified_at").between(F.lit(first), F.lit(last)))
    same = ["path", "modified_at"]
    return known.join(done, same, "left_anti").join(ledger.held(state, batch_id), same, "left_anti")


def commit(claim: Claim, rows_loaded: int, n_retries: int) -> None:
    """Make a batch visible to readers; the last step of a load."""
    claim.commit(rows_loaded, n_retries)


def plan_batch(files: DataFrame, rows: DataFrame, store: SalesStore, batch_id: str) -> DataFrame:
    """Header plan and date mode of all files of a batch, written once and read back.

    Stored, its size is known to Spark, which then broadcasts it to the rows.
    """
    spark = files.sparkSession
    header_path = store.path(f"header_plan/batch_id={batch_id}")
    plan_path = store.path(f"file_plan/batch_id={batch_id}")
    plan_files(files, store.threshold).write.mode("overwrite").parquet(header_path)
    planned = add_date_mode(spark.read.parquet(header_path), rows, store.cleaning)
    planned.write.mode("overwrite").parquet(plan_path)
    return spark.read.parquet(plan_path)


def ingest_files(files: DataFrame, store: SalesStore, batch_id: str) -> int:
    """Load one batch of workbooks ``(path, modificationTime)``; returns the number of sales rows appended.

    Files that another load has loaded, or is at, are left out; files whose next try is due come in. Bad files end up in
    the quarantine and the log; they never fail the batch. Raises ``ClaimLost``, with nothing loaded, if the
    load took so long without a sign of life that another one has taken its files over.
    """
    spark = files.sparkSession
    ship_package(spark)
    ledger = store.ledger(spark)
    claim = ledger.claim(batch_id, store.lease_seconds, lambda state: _claimable(files, ledger, state, batch_id))
    if claim is None:
        return 0
    claim.keep()
    try:
        loaded = _load(claim, store)
    except BaseException:
        claim.release()
        _discard(claim, store)
        raise
    ledger.compact(store.compact_every)
    return loaded


def _discard(claim: Claim, store: SalesStore) -> None:
    """Deletes what an attempt that was not committed has written, but for the log; no other attempt writes to its folders."""
    spark = claim.files.sparkSession
    for table in ("landing", "header_plan", "file_plan", "staging_sales", "file_report", "quarantine"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{store.root.rstrip('/')}/{table}/batch_id={claim.attempt_id}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _load(claim: Claim, store: SalesStore) -> int:
    """Loads the claimed files. The workbooks are decoded once into the landing table, which all later steps read."""
    spark, attempt = claim.files.sparkSession, claim.attempt_id
    loaded_at = F.lit(datetime.now(timezone.utc))
    taken = claim.files.select("path", F.col("modified_at").alias("modificationTime"))
    log_path = store.path(f"ingest_log/batch_id={attempt}")
    detected_events(taken, loaded_at).write.mode("overwrite").parquet(f"{log_path}/stage=detected")

    # A path is a few bytes but a workbook is much work: files are dealt out by number, not by size.
    tasks = min(claim.n_files, 4 * spark.sparkContext.defaultParallelism)
    landing_path = store.path(f"landing/batch_id={attempt}")
    with settings(spark, {**FREE_SHUFFLES, **TWO_FOLDERS}):
        scan_workbooks(taken.repartition(tasks), store.opener).write.mode("overwrite").partitionBy("kind").parquet(landing_path)
    landing = spark.read.schema(LANDING_SCHEMA).parquet(landing_path)
    rows, read = raw_rows(landing), raw_files(landing)
    n_put_off = _put_off(claim, landing, store)
    if n_put_off:
        put_off = spark.read.schema(RETRIES_SCHEMA).parquet(claim.retries_path)
        postponed_events(put_off, loaded_at).write.mode("overwrite").parquet(f"{log_path}/stage=postponed")
        read = read.join(put_off.select("path"), "path", "left_anti")
    planned = plan_batch(read, rows, store, attempt)

    cleaned = clean(rows, planned, store.cleaning).withColumn("loaded_at", loaded_at)
    # The count per file is taken from the stored rows; the path that tells files apart goes with them.
    loaded = append_sales(cleaned, store.path("staging_sales"), attempt, store.cluster_by)

    staged = read_batch(spark, store.path("staging_sales"), attempt)
    # Stored for the same reason as the file plan: the rejected rows are found without a shuffle.
    report_path = store.path(f"file_report/batch_id={attempt}")
    file_report(planned, count_rows(staged, "rows_kept")).write.mode("overwrite").parquet(report_path)
    report = spark.read.parquet(report_path)
    # Most rejected files were not readable, and have no rows to keep.
    if report.filter("reason IS NOT NULL AND rows_read > 0").limit(1).count():
        rejected = rejected_rows(rows, report)
        rejected.write.mode("overwrite").parquet(store.path(f"quarantine/batch_id={attempt}"))
    outcome_events(report, loaded_at).write.mode("overwrite").parquet(f"{log_path}/stage=outcome")
    commit(claim, loaded, n_put_off)
    return loaded


def append_batch(rows: DataFrame, store: SalesStore, name: str) -> int:
    """Append sales that are at hand as a DataFrame, as one committed batch; returns their number."""
    spark = rows.sparkSession
    claim = store.ledger(spark).claim(name, store.lease_seconds, lambda _: spark.createDataFrame([], CLAIMED_SCHEMA), empty=True)
    claim.keep()
    try:
        loaded = append_sales(rows, store.path("staging_sales"), claim.attempt_id, store.cluster_by)
        commit(claim, loaded, 0)
    except BaseException:
        claim.release()
        raise
    return loaded


def _put_off(claim: Claim, landing: DataFrame, store: SalesStore) -> int:
    """Writes down which files are tried again, and when; their number."""
    failed = storage_failures(landing)
    if not failed.limit(1).count():
        return 0
    due = F.timestamp_seconds(F.lit(time.time() + store.retry_seconds))
    again = claim.files.filter(F.col("attempt") < store.tries).join(failed, ["path", "modified_at"])
    again = again.select("path", "modified_at", "attempt", due.alias("due_at"), F.col("error").alias("reason"))
    again.write.mode("overwrite").parquet(claim.retries_path)
    return landing.sparkSession.read.schema(RETRIES_SCHEMA).parquet(claim.retries_path).count()


def load_put_off(spark: SparkSession, store: SalesStore, name: str | None = None) -> int:
    """Waits for and loads the files that were put off, until none is left that no other load is at; the rows appended."""
    name, total, turn = name or f"{_BATCH_PREFIX}{uuid.uuid4().hex}", 0, 0
    while True:
        ledger = store.ledger(spark)
        if not ledger.has_retries(ledger.state):
            return total
        waiting = ledger.retries(ledger.state).join(ledger.held(ledger.state, name), ["path", "modified_at"], "left_anti")
        due = waiting.agg(F.min(F.unix_micros("due_at"))).first()[0]
        if due is None:
            return total
        time.sleep(max(0.0, due / 1e6 - time.time()))
        total += ingest_files(spark.createDataFrame([], FILES_SCHEMA), store, f"{name}-again{turn:05d}")
        turn += 1


def ingest_folder(spark: SparkSession, folder: str, store: SalesStore, files_per_round: int = 10_000) -> int:
    """Load all workbooks of ``folder`` that no load has loaded or is at; returns the number of rows appended.

    The folder is listed once; the new files are dealt by ranges of a hash of their path into
    rounds of about ``files_per_round``, which are loaded one after the other. Files
    that were put off are tried again at the end.
    """
    run, total = f"{_BATCH_PREFIX}{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}", 0
    pending_path = store.path(f"pending/run={run}-{uuid.uuid4().hex}")
    ledger = store.ledger(spark)
    new_files(workbook_files(spark, folder), ledger.loaded(ledger.state)).write.parquet(pending_path)
    pending = spark.read.schema(FILES_SCHEMA).parquet(pending_path)
    rounds = math.ceil(pending.count() / files_per_round)
    place = F.xxhash64("path").cast("double")
    cuts = pending.select(place.alias("place")).approxQuantile("place", [i / rounds for i in range(1, rounds)], 0.1 / rounds) if rounds > 1 else []
    for i, (low, high) in enumerate(zip([-math.inf, *cuts], [*cuts, math.inf], strict=True)):
        if rounds:
            part = pending.filter((place > low) & (place <= high))
            total += ingest_files(part, store, f"{run}-{i:05d}")
    return total + load_put_off(spark, store, run)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name kept beside the checkpoint, so that only its own stream writes under it."""
    path, schema = f"{checkpoint.rstrip('/')}/ingest_id", T.StructType([T.StructField("id", T.StringType())])
    known = read_table(spark, path, schema).first()
    if known is None:
        spark.createDataFrame([(f"stream-{uuid.uuid4().hex}",)], schema).coalesce(1).write.mode("overwrite").parquet(path)
        known = read_table(spark, path, schema).first()
    return known.id


def start_ingest_stream(
    files: DataFrame,
    store: SalesStore,
    checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Load a stream of workbooks until stopped, or just the backlog.

    ``files`` is a streaming DataFrame of workbooks, see ``workbook_stream``.
    The checkpoint remembers which files were read, and names the batches; the
    store's ledger sees to it that each file is loaded once, also beside other
    streams and batch jobs on the same folder, at the same time or not.
    """
    stream = _stream_id(files.sparkSession, checkpoint)

    def load(batch: DataFrame, epoch: int) -> None:
        name = f"{stream}-{epoch:09d}"
        ingest_files(batch, store, name)
        load_put_off(batch.sparkSession, store, name)

    writer = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with settings(files.sparkSession, listing(files.sparkSession)):  # a stream keeps the settings it starts with
        return writer.start()
