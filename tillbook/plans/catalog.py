"""The registered queries: name -> function of ``(spark, sf_dir)``.

The star tables are loaded into a sales table first, as they would be in use,
and the untidy raw input into a landing table. Both are written once per
application to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.money import money_avg, money_sum
from tillbook.functions.sketch import STANDARD_ERROR
from tillbook.operators.cleaning import CleaningOptions, add_date_mode, clean
from tillbook.operators.filters import filter_sales
from tillbook.operators.headers import built_in_aliases, header_map, plan_files
from tillbook.operators.verdict import count_rows, detected_events, file_report, outcome_events, rejected_rows
from tillbook.plans.dashboard import PANELS
from tillbook.plans.order import disorders
from tillbook.plans.sample_books import busy_opener, workbook_bytes, write_file, write_workbooks
from tillbook.plans.states import PanelStates
from tillbook.plans.untidy import untidy_files, untidy_rows
from tillbook.plans.views import VIEWS, register_views
from tillbook.schema import CANONICAL_COLUMNS, INGEST_LOG_SCHEMA, SALES_COLUMNS
from tillbook.package import ship_package
from tillbook.sources.folder import workbook_files, workbook_stream
from tillbook.sources.settings import TWO_FOLDERS, settings
from tillbook.sources.staging import append_sales, query, query_scalar, read_sales
from tillbook.sources.star import star_sales
from tillbook.sources.workbook import raw_files, raw_rows, scan_workbooks
from tillbook.streaming.ingest import SalesStore, append_batch, ingest_folder, start_ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

_LOCAL_FOLDER: list[tempfile.TemporaryDirectory] = []
_WRITTEN: dict[tuple[str, str, str], str] = {}
_TABLES: dict[str, str] = {}

#: Raw rows of a bucket, about: some 50 MB in memory.
_ROWS_PER_BUCKET = 250_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return f"{named.rstrip('/')}/tillbook"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.TemporaryDirectory(prefix="tillbook-"))
    return _LOCAL_FOLDER[0].name


def _new_folder(spark: SparkSession, what: str) -> str:
    """A path for derived data, below a folder that is deleted when the application ends."""
    base = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{base}/{what}-{uuid.uuid4().hex}"


def _written(spark: SparkSession, sf_dir: str, what: str, write: Callable[[str], object]) -> str:
    """Path of a derived table, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _WRITTEN:
        path = _new_folder(spark, what)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales table loaded from the star tables."""
    path = _written(
        spark, sf_dir, "staging_sales", lambda p: append_sales(star_sales(spark, sf_dir), p, "star")
    )
    return read_sales(spark, path)


def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows of all untidy files, as a scan would leave them."""
    name = f"tillbook_raw_rows_{uuid.uuid4().hex}"

    def write(path: str) -> None:
        # The rows of a file lie together, as a scan leaves them: counts per file and joins with the file plan need no shuffle of rows.
        parts = max(1, math.ceil(spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() / _ROWS_PER_BUCKET))
        untidy_rows(spark, sf_dir, parts).write.bucketBy(parts, "path").sortBy("path").option("path", path).saveAsTable(name)
        _TABLES[path] = name

    path = _written(spark, sf_dir, "raw_rows", write)
    return spark.table(_TABLES[path])


def landing_plan(spark: SparkSession, sf_dir: str, options: CleaningOptions = CleaningOptions()) -> DataFrame:
    """All untidy files with their row counts, header plan and date mode."""
    rows = landing_rows(spark, sf_dir)

    def write(path: str) -> None:
        files = untidy_files(spark, sf_dir).join(count_rows(rows, "rows_read"), "path", "left")
        add_date_mode(plan_files(files), rows, options).write.parquet(path)

    return spark.read.parquet(_written(spark, sf_dir, f"file_plan{len(options.date_formats)}", write))


def _view(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return VIEWS[name](sales_table(spark, sf_dir))


def _panel(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return PANELS[name](sales_table(spark, sf_dir))


def staging_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table read back, after the append."""
    return sales_table(spark, sf_dir).select(*SALES_COLUMNS)


def filtered_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range with a region and a category list."""
    return filter_sales(
        sales_table(spark, sf_dir),
        date_from=date(1996, 3, 15),
        date_to=date(1998, 2, 10),
        regions=["ASIA", "EUROPE"],
        categories=["PROMO", "ECONOMY"],
    ).select(*SALES_COLUMNS)


def filtered_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of two customers."""
    customers = ["Customer#000000007", "Customer#000000042"]
    return filter_sales(sales_table(spark, sf_dir), customers=customers).select(*SALES_COLUMNS)


def filtered_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales that came in one file."""
    return filter_sales(sales_table(spark, sf_dir), source_files=["sales_1997.xlsx"]).select(*SALES_COLUMNS)


def filtered_by_load_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales that were loaded within half a year."""
    bounds = {"loaded_from": datetime(1997, 1, 1), "loaded_to": datetime(1997, 6, 30)}
    return filter_sales(sales_table(spark, sf_dir), **bounds).select(*SALES_COLUMNS)


_CLUSTERED = ("region", "city", "product_category", "customer_name")


def clustered_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales table, stored along a curve through four columns."""
    path = _written(
        spark, sf_dir, "clustered_sales", lambda p: append_sales(star_sales(spark, sf_dir), p, "star", _CLUSTERED)
    )
    return read_sales(spark, path)


def clustered_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of three cities, from the table along the curve."""
    return filter_sales(clustered_sales(spark, sf_dir), cities=["NATION_1_C1", "NATION_8_C2", "NATION_17_C3"]).select(*SALES_COLUMNS)


def clustered_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of one category, from the table along the curve."""
    return filter_sales(clustered_sales(spark, sf_dir), categories=["PROMO"]).select(*SALES_COLUMNS)


def fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and averages of amounts with many decimals, per category."""
    part = F.col("sales_amount") / 7.0
    sums = sales_table(spark, sf_dir).groupBy("product_category").agg(money_sum(part).alias("total"), money_avg(part).alias("average"))
    return sums.select("product_category", "total", "average")


def mapped_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every header of every untidy file with its match."""
    return header_map(untidy_files(spark, sf_dir)).drop("path")


def mapped_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the aliases as a table, through the index of letter pairs."""
    return header_map(untidy_files(spark, sf_dir), aliases=built_in_aliases(spark)).drop("path")


def planned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and duplicated columns per untidy file."""
    return plan_files(untidy_files(spark, sf_dir)).select(
        "source_file",
        F.array_join("missing", ", ").alias("missing"),
        F.array_join("duplicated", ", ").alias("duplicated"),
    )


def clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed rows of the usable untidy files."""
    return clean(landing_rows(spark, sf_dir), landing_plan(spark, sf_dir)).drop("path")


ISO_ONLY = CleaningOptions(date_formats=("yyyy-MM-dd",), infer_dates=False)


def clean_sales_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ISO dates only, among those written as text."""
    rows, planned = landing_rows(spark, sf_dir), landing_plan(spark, sf_dir, ISO_ONLY)
    return clean(rows, planned, ISO_ONLY).drop("path")


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, planned = landing_rows(spark, sf_dir), landing_plan(spark, sf_dir)
    return file_report(planned, count_rows(clean(rows, planned), "rows_kept"))


def report_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and rejection reason per untidy file."""
    return _report(spark, sf_dir).drop("path", "modified_at", "seconds")


def stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as ingest keeps it: a table whose size is known."""
    return spark.read.parquet(
        _written(spark, sf_dir, "file_report", lambda p: _report(spark, sf_dir).write.parquet(p))
    )


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the rejected untidy files."""
    rejected = rejected_rows(landing_rows(spark, sf_dir), stored_report(spark, sf_dir))
    return rejected.select("source_file", "row_no", F.size("cells").cast("bigint").alias("cell_count"), "reason")


def file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest log of the untidy files, with the time of the load set."""
    report = stored_report(spark, sf_dir).withColumn("seconds", F.lit(0.0))
    at = F.lit(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
    files = report.select("path", F.col("modified_at").alias("modificationTime"))
    return detected_events(files, at).unionByName(outcome_events(report, at)).select(
        "source_file", "event", "rows_read", "rows_loaded", "message", "disposition", "target_name"
    )


def inbox(spark: SparkSession, sf_dir: str, part: int | None = None) -> str:
    """A folder with all sales as workbooks, or half of them, beside what is not to be loaded.

    Both halves use the same file names. There are files with other endings, a
    sub-folder with workbooks, one file that is no workbook and one that is cut off.
    """
    ship_package(spark)
    sales = sales_table(spark, sf_dir)
    rows = sales if part is None else sales.filter(F.pmod(F.xxhash64("customer_name", "sale_date"), F.lit(2)) == part)

    def write(path: str) -> None:
        write_workbooks(rows, path)
        sound = workbook_bytes(CANONICAL_COLUMNS, [["x"] * len(CANONICAL_COLUMNS)])
        for name, content in (
            ("notes.txt", b"x"), ("sales.xlsb", sound), ("done/sales-00000-00000.xlsx", sound), ("day=1/a.xlsx", sound),
            ("text.xlsx", b"not a workbook"), ("cut.xlsx", sound[: len(sound) // 2]),
        ):
            write_file(f"{path}/{name}", content)

    return _written(spark, sf_dir, "inbox" if part is None else f"inbox{part}", write)


def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, stored as workbooks, decoded, aligned and cleaned."""
    folder = inbox(spark, sf_dir)

    def write(path: str) -> None:
        with settings(spark, TWO_FOLDERS):
            scan_workbooks(workbook_files(spark, folder)).write.partitionBy("kind").parquet(path)

    landing = spark.read.parquet(_written(spark, sf_dir, "workbook_rows", write))
    rows = raw_rows(landing)
    planned = spark.read.parquet(
        _written(
            spark, sf_dir, "workbook_plan",
            lambda p: add_date_mode(plan_files(raw_files(landing)), rows).write.parquet(p),
        )
    )
    return clean(rows, planned).select(*CANONICAL_COLUMNS)


def _load_stream(spark: SparkSession, folder: str, store: SalesStore, checkpoint: str) -> None:
    files = workbook_stream(spark, folder, files_per_trigger=1_000)
    start_ingest_stream(files, store, checkpoint, available_now=True).awaitTermination()


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, stored as workbooks and loaded by the stream into a new store."""
    root = _new_folder(spark, "stream")
    store = SalesStore(f"{root}/store")
    _load_stream(spark, inbox(spark, sf_dir), store, f"{root}/checkpoint")
    return store.sales(spark).select(*CANONICAL_COLUMNS, "sale_month")


def folder_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, loaded by the batch job from two folders whose files have the same names."""
    store = SalesStore(f"{_new_folder(spark, 'batch')}/store")
    for part in (0, 1):
        ingest_folder(spark, inbox(spark, sf_dir, part), store)
    return store.sales(spark).select(*CANONICAL_COLUMNS)


def batch_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder loaded by the batch job, and then by a stream, which finds nothing new."""
    root = _new_folder(spark, "both")
    store = SalesStore(f"{root}/store")
    ingest_folder(spark, inbox(spark, sf_dir), store)
    _load_stream(spark, inbox(spark, sf_dir), store, f"{root}/checkpoint")
    return store.sales(spark).select(*CANONICAL_COLUMNS)


def two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams, each with a checkpoint of its own, over two folders and then the other one."""
    root = _new_folder(spark, "streams")
    store = SalesStore(f"{root}/store")
    for stream, part in ((0, 0), (1, 1), (2, 0), (3, 1)):
        _load_stream(spark, inbox(spark, sf_dir, part), store, f"{root}/checkpoint{stream}")
    return store.sales(spark).select(*CANONICAL_COLUMNS)


class _Stopped(Exception):
    """Stands for the end of a job in the middle of a load."""


class _StoppingStore(SalesStore):
    def path(self, table: str) -> str:
        if table.startswith("file_report"):
            raise _Stopped
        return super().path(table)


def ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch job that stops after its rows are written, and is run again."""
    root = f"{_new_folder(spark, 'resumed')}/store"
    try:
        ingest_folder(spark, inbox(spark, sf_dir), _StoppingStore(root))
    except _Stopped:
        ingest_folder(spark, inbox(spark, sf_dir), SalesStore(root))
    return SalesStore(root).sales(spark).select(*CANONICAL_COLUMNS)


@dataclass(frozen=True)
class _InterruptedStore(SalesStore):
    """Lets other loads run in the middle of its own, when their rows are written but not committed."""

    others: list[Callable[[], object]] = field(default_factory=list)

    def path(self, table: str) -> str:
        if table.startswith("file_report") and self.others:
            self.others.pop()()
        return super().path(table)


def overlapping_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder loaded by two loads at a time: batch job in stream, stream in batch job, batch job in batch job."""
    folder = inbox(spark, sf_dir)
    half = math.ceil(workbook_files(spark, folder).count() / 2)

    def batch(store: SalesStore) -> None:
        ingest_folder(spark, folder, store, files_per_round=half)

    def stream(store: SalesStore) -> None:
        files = workbook_stream(spark, folder, files_per_trigger=half)
        start_ingest_stream(files, store, f"{store.root}-checkpoint", available_now=True).awaitTermination()

    loaded = []
    for name, outer, inner in (("batch in stream", stream, batch), ("stream in batch", batch, stream), ("batch in batch", batch, batch)):
        root = f"{_new_folder(spark, 'overlap')}/store"
        outer(_InterruptedStore(root, others=[partial(inner, SalesStore(root))]))
        loaded.append(SalesStore(root).sales(spark).select(F.lit(name).alias("loads"), *CANONICAL_COLUMNS))
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


def retried_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales, loaded from a folder of which every third file opens at the third try only."""
    root = _new_folder(spark, "retried")
    store = SalesStore(f"{root}/store", retry_seconds=0.2, opener=busy_opener(f"{root}/tries", 2))
    ingest_folder(spark, inbox(spark, sf_dir), store)
    return store.sales(spark).select(*CANONICAL_COLUMNS)


def log_after_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per month after many small loads, snapshots of the ledger between them, and loads that find nothing new."""
    store = SalesStore(f"{_new_folder(spark, 'compacted')}/store", compact_every=3)
    for part in (0, 1, 0, 1):
        folder = inbox(spark, sf_dir, part)
        ingest_folder(spark, folder, store, files_per_round=math.ceil(workbook_files(spark, folder).count() / 3))
    total = store.commits(spark).agg(F.sum("rows_loaded").alias("n")).scalar()
    months = store.sales(spark).groupBy("sale_month").agg(F.count(F.lit(1)).alias("rows_loaded"), F.sum("quantity").alias("units"))
    return months.withColumn("rows_committed", total)


def _refreshed_store(spark: SparkSession, sf_dir: str) -> SalesStore:
    """All sales in three batches, with panels refreshed after each, by distinct values and by sketches."""

    def write(path: str) -> None:
        store = SalesStore(path)
        for part in range(3):
            sales = sales_table(spark, sf_dir).filter(F.pmod(F.xxhash64("customer_name", "sale_date"), F.lit(3)) == part)
            append_batch(sales.select(*SALES_COLUMNS), store, f"part-{part}")
            for approximate in (False, True):
                PanelStates(spark, store, approximate).refresh()

    return SalesStore(_written(spark, sf_dir, "refreshed", write))


def _refreshed(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return PanelStates(spark, _refreshed_store(spark, sf_dir)).panels()[name]


def approx_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region and state, the exact number of customers, and whether merged sketches come within three standard errors."""
    store = _refreshed_store(spark, sf_dir)
    exact, approximate = (PanelStates(spark, store, a).rows("regional") for a in (False, True))
    near = approximate.select(F.col("region").alias("r"), F.col("state").alias("s"), F.col("unique_customers").alias("approx"))
    both = exact.join(near, F.col("region").eqNullSafe(F.col("r")) & F.col("state").eqNullSafe(F.col("s")))
    within = F.abs(F.col("approx") - F.col("unique_customers")) <= F.greatest(F.lit(1.0), 3 * STANDARD_ERROR * F.col("unique_customers"))
    return both.select("region", "state", "unique_customers", within.alias("within_error"))


ORDERED_VIEWS = ("v_daily_sales", "v_regional_performance", "v_date_region", "v_heatmap_region_month")
ORDERED_PANELS = {"daily_sales": ("sale_date",), "regional": ("-total_revenue",), "file_statistics": ("-first_loaded_at",)}


def row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ordered views and panels, and how many neighbours among them stand the wrong way round."""
    sales = sales_table(spark, sf_dir)
    views = {v: (VIEWS[v](sales), VIEWS[v].order) for v in ORDERED_VIEWS}
    return disorders(views | {p: (PANELS[p](sales), order) for p, order in ORDERED_PANELS.items()})


def sql_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view by SQL with a parameter, beside scalars: all rows, a query without rows, and a table that was never written."""
    register_views(spark, sales_table(spark, sf_dir))
    rows = query(spark, "SELECT region, state, total_orders FROM v_regional_performance WHERE region = :r", {"r": "ASIA"})
    everything = query_scalar(spark, "SELECT count(*) FROM staging_sales")
    nothing = query_scalar(spark, "SELECT total_revenue FROM v_daily_sales WHERE sale_date < DATE '1900-01-01'")
    unwritten = SalesStore(f"{_new_folder(spark, 'unwritten')}/store").sales(spark).count()
    return rows.withColumns({"all_rows": F.lit(everything), "no_row": F.lit(nothing is None), "unwritten_rows": F.lit(unwritten)})


def load_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without a loading time, appended in three batches: rows and distinct loading times of each, and whether these are of now."""
    store, begun = SalesStore(f"{_new_folder(spark, 'defaults')}/store"), datetime.now(timezone.utc)
    for part in range(3):
        rows = sales_table(spark, sf_dir).filter(F.year("sale_date") % 3 == part).select(*CANONICAL_COLUMNS, "source_file")
        append_batch(rows, store, f"part-{part}")
    times = F.coalesce(F.min("loaded_at") >= F.lit(begun), F.lit(False)) & (F.max("loaded_at") <= F.current_timestamp())
    per_batch = store.sales(spark).groupBy(F.split("batch_id", "[.]")[0].alias("batch"))
    return per_batch.agg(F.count("loaded_at").alias("rows_loaded"), F.countDistinct("loaded_at").alias("n_times"), times.alias("of_now"))


def last_resort_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of sale per year, from files whose cells mostly have one format, some a time of day, and some one-digit parts."""
    days = sales_table(spark, sf_dir).filter("sale_date IS NOT NULL").select("sale_date").distinct()
    kind = F.dayofyear("sale_date") % 5
    cell = (
        F.when(kind == 0, F.date_format("sale_date", "yyyy-M-d"))
        .when(kind == 1, F.date_format("sale_date", "yyyy-MM-dd'T'10:20:30"))
        .otherwise(F.date_format("sale_date", "dd/MM/yyyy"))
    )
    path = F.concat(F.lit("/inbox/"), F.year("sale_date").cast("string"), F.lit(".xlsx"))
    cells = F.array(cell, *[F.lit("1") for _ in CANONICAL_COLUMNS[1:]])
    rows = days.select(path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("source_file"), F.unix_date("sale_date").cast("long").alias("row_no"), cells.alias("cells"))
    files = rows.select("path", "source_file").distinct().select("*", F.array(*map(F.lit, CANONICAL_COLUMNS)).alias("headers"), F.lit(None).cast("string").alias("error"))
    return clean(rows, add_date_mode(plan_files(files), rows)).select("source_file", "sale_date")


def long_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events of one rejected file per customer, whose reason is longer than a message may be."""
    reason = F.repeat(F.concat_ws("; ", "c_name", "c_mktsegment"), 40)
    given = {"source_file": F.concat("c_name", F.lit(".xlsx")), "reason": reason}
    unknown = {f.name: F.lit(None).cast(f.dataType) for f in INGEST_LOG_SCHEMA}
    columns = ("source_file", "path", "modified_at", "columns_read", "rows_read", "rows_loaded", "rows_dropped", "seconds", "reason")
    report = spark.read.parquet(f"{sf_dir}/customer.parquet").select(*[given.get(c, unknown.get(c, F.lit(None))).alias(c) for c in columns])
    at = F.lit(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc))
    return outcome_events(report, at).select("source_file", "event", "message", "target_name")


def queries() -> dict[str, Query]:
    """Every registered query."""
    out: dict[str, Query] = {v.removeprefix("v_"): partial(_view, v) for v in VIEWS}
    out.update({f"dash_{p}": partial(_panel, p) for p in PANELS})
    out.update({f"refreshed_{p}": partial(_refreshed, p) for p in PANELS})
    out.update(
        staging_rows=staging_rows,
        fine_amounts=fine_amounts,
        filtered_sales=filtered_sales,
        filtered_by_customer=filtered_by_customer,
        filtered_by_file=filtered_by_file,
        filtered_by_load_time=filtered_by_load_time,
        clustered_by_city=clustered_by_city,
        clustered_by_category=clustered_by_category,
        header_map=mapped_headers,
        header_map_by_table=mapped_by_table,
        file_plan=planned_files,
        clean_sales=clean_sales,
        clean_sales_iso=clean_sales_iso,
        file_report=report_per_file,
        quarantined_rows=quarantined_rows,
        file_events=file_events,
        workbook_scan=workbook_scan,
        stream_ingest=stream_ingest,
        folder_batch=folder_batch,
        batch_then_stream=batch_then_stream,
        two_streams=two_streams,
        ingest_resumed=ingest_resumed,
        overlapping_loads=overlapping_loads,
        retried_files=retried_files,
        log_after_compaction=log_after_compaction,
        approx_customers=approx_customers,
        row_order=row_order,
        sql_access=sql_access,
        load_defaults=load_defaults,
        last_resort_dates=last_resort_dates,
        long_messages=long_messages,
    )
    return out
