"""Dashboard panels that are brought up to date from new batches only.

For each panel the store keeps one row per key with parts that add up: counts, the three whole-number parts
of money sums, minima and maxima. For distinct counts it keeps the distinct values per key, or, if asked for,
a sketch of them. A refresh aggregates the batches committed since the last one, merges their rows with
the kept ones, and writes a new generation; it reads no sales row of an older batch, and those of the new ones three times,
once per grouping that panels share (kept beside them as ``new-...``). Two refreshes at a time
write a generation each, and either is complete up to the commit it names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.money import unit_parts, units_2dp, units_avg, units_of
from tillbook.functions.sketch import estimate, merged_sketch, sketch
from tillbook.plans.dashboard import SHAPES
from tillbook.schema import STAGING_SCHEMA
from tillbook.sources.objects import objects
from tillbook.streaming.ingest import SalesStore

_LATEST = "latest.json"
_SIDE_BY_SIDE = 4
_MONEY = {"amount": "sales_amount", "price": "price_per_unit"}


def _parts(names: tuple[str, ...]) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates over sales rows by the name of their column, and those that merge such columns."""
    made: dict[str, Column] = {}
    merge: dict[str, Column] = {}
    for name in names:
        if name in _MONEY:
            x = F.col(_MONEY[name])
            for part, column in zip(("low", "middle", "rest"), unit_parts(x), strict=True):
                made[f"{name}_{part}"] = column
                total = F.sum(f"{name}_{part}")
                merge[f"{name}_{part}"] = total if part == "rest" else total.cast("decimal(20,0)")
            made[f"{name}_n"], merge[f"{name}_n"] = F.count(x), F.sum(f"{name}_n")
        elif name == "rows":
            made[name], merge[name] = F.count(F.lit(1)), F.sum(name)
        elif name == "quantity":
            made[name], merge[name] = F.sum(name), F.sum(name)
        else:  # the earliest loading time
            made[name], merge[name] = F.min(name), F.min(name)
    return made, merge


def _units(name: str) -> Column:
    return units_of(*[F.col(f"{name}_{p}") for p in ("low", "middle", "rest")])


def _sum(name: str) -> Column:
    return units_2dp(_units(name))


def _avg(name: str) -> Column:
    return units_avg(_units(name), F.col(f"{name}_n"))


@dataclass(frozen=True)
class PanelState:
    """What is kept for a panel, and the columns of its view that are made from it."""

    keys: tuple[str, ...]
    parts: tuple[str, ...]
    columns: dict[str, Callable[[], Column]]
    distinct: tuple[tuple[str, str], ...] = ()  # (column of the view, whose values are counted)
    not_null: tuple[str, ...] = ()


def _or_zero(value: Callable[[], Column], kind: str) -> Callable[[], Column]:
    return lambda: F.coalesce(value(), F.lit(0).cast(kind))


_CUSTOMERS = ("unique_customers", "customer_name")

STATES: dict[str, PanelState] = {
    "kpis": PanelState(
        (), ("rows", "quantity", "amount"),
        {
            "total_revenue": _or_zero(lambda: _sum("amount"), "decimal(38,2)"),
            "total_transactions": _or_zero(lambda: F.col("rows"), "bigint"),
            "total_units_sold": _or_zero(lambda: F.col("quantity"), "bigint"),
            "avg_order_value": _or_zero(lambda: _avg("amount"), "decimal(38,2)"),
        },
        (_CUSTOMERS, ("files_processed", "source_file")),
    ),
    "daily_sales": PanelState(
        ("sale_date",), ("rows", "amount"),
        {"total_revenue": lambda: _sum("amount"), "transaction_count": lambda: F.col("rows")}, not_null=("sale_date",),
    ),
    "regional": PanelState(
        ("region", "state"), ("rows", "amount"),
        {"total_revenue": lambda: _sum("amount"), "total_orders": lambda: F.col("rows")}, (_CUSTOMERS,),
    ),
    "category": PanelState(
        ("product_category",), ("quantity", "amount"),
        {"total_revenue": lambda: _sum("amount"), "total_units": lambda: F.col("quantity")},
    ),
    "top_products": PanelState(
        ("product_name", "product_category"), ("quantity", "amount", "price"),
        {"total_revenue": lambda: _sum("amount"), "total_units_sold": lambda: F.col("quantity"), "avg_price": lambda: _avg("price")},
    ),
    "top_customers": PanelState(
        ("customer_name", "city", "state", "region"), ("rows", "amount"),
        {"total_orders": lambda: F.col("rows"), "total_spent": lambda: _sum("amount"), "avg_order_value": lambda: _avg("amount")},
    ),
    "file_statistics": PanelState(
        ("source_file",), ("rows", "amount", "loaded_at"),
        {"records_loaded": lambda: F.col("rows"), "first_loaded_at": lambda: F.col("loaded_at"), "total_revenue": lambda: _sum("amount")},
    ),
}


#: What the new sales are grouped by, each in one pass over them: a panel whose keys are among those of a grouping,
#: and whose distinct values are too, is made from its rows, which are fewer.
GROUPINGS: dict[str, PanelState] = {
    "customers": PanelState(("customer_name", "city", "state", "region"), ("rows", "quantity", "amount"), {}),
    "products": PanelState(("product_name", "product_category"), ("quantity", "amount", "price"), {}),
    "days": PanelState(("source_file", "sale_date"), ("rows", "amount", "loaded_at"), {}),
}


def _grouping(columns: tuple[str, ...], parts: tuple[str, ...] = ()) -> str:
    """The first grouping that has these columns and parts."""
    return next(n for n, g in GROUPINGS.items() if {*columns} <= {*g.keys} and {*parts} <= {*g.parts})


def _write_all(tables: dict[str, DataFrame]) -> None:
    """Writes each table to its path, side by side: most of them are small and leave cores idle."""
    with ThreadPoolExecutor(_SIDE_BY_SIDE) as pool:
        list(pool.map(lambda path: tables[path].write.parquet(path), tables))


class PanelStates:
    """The kept rows of all panels of a store; ``approximate`` keeps sketches in place of distinct values."""

    def __init__(self, spark: SparkSession, store: SalesStore, approximate: bool = False) -> None:
        self.spark, self.store, self.approximate = spark, store, approximate
        self.root = store.path("panel_sketches" if approximate else "panel_states")
        self.objects = objects(spark, f"{self.root}/entries")

    def _latest(self) -> dict | None:
        text = self.objects.read(_LATEST)
        return None if text is None else json.loads(text)

    def new_rows(self, since: int) -> tuple[DataFrame | None, int]:
        """The sales of the batches committed after entry ``since``, read from their folders only, and the last such entry."""
        new = self.store.commits(self.spark).filter(F.col("number") > since).select("batch_id", "number", "rows_loaded").collect()
        base = self.store.path("staging_sales")
        folders = [f"{base}/batch_id={r.batch_id}" for r in new if r.rows_loaded]
        rows = self.spark.read.schema(STAGING_SCHEMA).option("basePath", base).parquet(*folders) if folders else None
        return rows, max([since, *[r.number for r in new]])

    def _distinct(self, rows: DataFrame, state: PanelState, column: str) -> DataFrame:
        """Distinct values per key, or their sketch."""
        if self.approximate:
            return rows.groupBy(*state.keys).agg(sketch(column).alias("seen"))
        return rows.filter(F.col(column).isNotNull()).select(*state.keys, F.col(column).alias("seen")).distinct()

    def _with(self, what: DataFrame, before: str | None) -> DataFrame:
        return what if before is None else what.unionByName(self.spark.read.schema(what.schema).parquet(before))

    def refresh(self) -> None:
        """Takes the batches committed since the last refresh into a new generation."""
        latest = self._latest()
        sales, number = self.new_rows(latest["number"] if latest else 0)
        if sales is None and latest is not None:
            return
        sales = self.spark.createDataFrame([], STAGING_SCHEMA) if sales is None else sales
        path = f"{self.root}/generation-{number:012d}-{uuid.uuid4().hex}"
        grouped = {n: sales.groupBy(*g.keys).agg(*[c.alias(part) for part, c in _parts(g.parts)[0].items()]) for n, g in GROUPINGS.items()}
        _write_all({f"{path}/new-{n}": rows for n, rows in grouped.items()})
        grouped = {n: self.spark.read.schema(rows.schema).parquet(f"{path}/new-{n}") for n, rows in grouped.items()}
        tables = {}
        for name, state in STATES.items():
            merge = _parts(state.parts)[1]
            rows = grouped[_grouping(state.keys, state.parts)]
            rows = rows.dropna(subset=list(state.not_null)) if state.not_null else rows
            rows = self._with(rows.select(*state.keys, *merge), f"{latest['path']}/{name}" if latest else None)
            tables[f"{path}/{name}"] = rows.groupBy(*state.keys).agg(*[c.alias(n) for n, c in merge.items()])
            for result, column in state.distinct:
                rows = self._distinct(grouped[_grouping((*state.keys, column))], state, column)
                if latest:
                    rows = self._with(rows, f"{latest['path']}/{name}-{result}")
                    rows = rows.groupBy(*state.keys).agg(merged_sketch("seen").alias("seen")) if self.approximate else rows.distinct()
                tables[f"{path}/{name}-{result}"] = rows
        _write_all(tables)
        self.objects.replace(_LATEST, json.dumps({"number": number, "path": path}))

    def rows(self, name: str) -> DataFrame:
        """The columns of the panel's view, as of the last refresh."""
        state, path = STATES[name], self._latest()["path"]
        out = self.spark.read.parquet(f"{path}/{name}").select(*state.keys, *[c().alias(n) for n, c in state.columns.items()])
        for result, _ in state.distinct:
            seen = self.spark.read.parquet(f"{path}/{name}-{result}")
            if self.approximate:
                counts = seen.select(*[F.col(k).alias(f"_{k}") for k in state.keys], estimate("seen").alias(result))
            else:
                counts = seen.groupBy(*[F.col(k).alias(f"_{k}") for k in state.keys]).agg(F.count(F.lit(1)).alias(result))
            if not state.keys:
                out = out.withColumn(result, F.coalesce(counts.scalar(), F.lit(0)))
                continue
            same = F.lit(True)
            for k in state.keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            out = out.join(counts, same, "left").withColumn(result, F.coalesce(result, F.lit(0))).drop(*[f"_{k}" for k in state.keys])
        return out

    def panels(self) -> dict[str, DataFrame]:
        """All panels as of the last refresh."""
        return {name: shape(self.rows(name)) for name, (_, shape) in SHAPES.items()}


def refresh_panels(spark: SparkSession, store: SalesStore, approximate: bool = False) -> dict[str, DataFrame]:
    """All panels on the table as it is now; reads the batches that were committed since the last call."""
    states = PanelStates(spark, store, approximate)
    states.refresh()
    return states.panels()
