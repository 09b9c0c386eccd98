"""Who loads which files: numbered entries that any number of loads append to, each number given out once.

A load claims its files before it reads them. The number of its claim is its fencing number and part of the
names of all its folders. The claim holds for a time and is extended as the load goes on; another load may take
files over only after it has run out or was released. A commit is an entry too, and is refused for a claim
that is no longer held. Whoever appends has seen all entries before its own, so two loads never hold the
same file, and a load that was taken for dead can't commit.

Once in a while the files and commits up to an entry are merged into a snapshot. A load starts from the last
one and reads the entries since. Merging keeps a few segments of growing size, so that a file is written again only a
logarithmic number of times. Leases compare the clocks of the drivers.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.schema import CLAIMED_SCHEMA, COMMITS_SCHEMA, LOADED_SCHEMA, RETRIES_SCHEMA
from tillbook.sources.objects import objects
from tillbook.sources.staging import read_table

_LATEST = "latest.json"
#: A segment is merged with the next smaller one if that is not this many times smaller.
_RATIO = 3


class ClaimLost(RuntimeError):
    """The claim of this load has run out and was taken over, or was released."""


@dataclass
class State:
    """What the entries up to ``number`` amount to."""

    number: int = 0
    since: int = 0
    active: dict[int, dict] = field(default_factory=dict)
    commits: list[dict] = field(default_factory=list)  # since the snapshot
    loaded: list[list] = field(default_factory=list)  # segments (path, rows) of the snapshot, largest first
    committed: list[list] = field(default_factory=list)
    retries: str | None = None

    def apply(self, entry: dict) -> None:
        self.number += 1
        kind = entry["kind"]
        if kind == "claim":
            for number in entry["instead"]:
                self.active.pop(number, None)
            self.active[self.number] = entry
        elif kind == "extend" and entry["claim"] in self.active:
            self.active[entry["claim"]]["until"] = entry["until"]
        elif kind == "release":
            self.active.pop(entry["claim"], None)
        elif kind == "commit" and entry["claim"] in self.active:
            claim = self.active.pop(entry["claim"])
            self.commits.append({**claim, **entry, "number": self.number})

    def text(self) -> str:
        kept = ("number", "active", "loaded", "committed", "retries")
        return json.dumps({k: getattr(self, k) for k in kept})

    @classmethod
    def of(cls, text: str) -> State:
        known = json.loads(text)
        known["active"] = {int(n): c for n, c in known["active"].items()}
        return cls(since=known["number"], **known)


class Ledger:
    """The entries below ``root``; tables of claimed files and snapshots lie beside them."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.objects = objects(spark, f"{self.root}/entries")
        self._lock = threading.Lock()
        latest = self.objects.read(_LATEST)
        self.state = State.of(self.objects.read(json.loads(latest)["snapshot"])) if latest else State()
        self.refresh()

    def refresh(self) -> State:
        """Takes up the entries that were appended since."""
        with self._lock:
            while (text := self.objects.read(f"{self.state.number + 1:012d}.json")) is not None:
                self.state.apply(json.loads(text))
        return self.state

    def append(self, make: Callable[[State], dict | None]) -> int | None:
        """Appends what ``make`` gives for the state right before it; its number, or None if there is nothing to append."""
        while True:
            entry = make(self.refresh())
            if entry is None:
                return None
            number = self.state.number + 1
            if self.objects.create(f"{number:012d}.json", json.dumps(entry)):
                self.refresh()
                return number

    # Claims -------------------------------------------------------------------------------------

    def claim(self, batch_id: str, lease: float, choose: Callable[[State], DataFrame], empty: bool = False) -> Claim | None:
        """Claims the files that ``choose`` gives (``CLAIMED_SCHEMA``); None if there are none, unless ``empty`` is set.

        ``choose`` is asked again if another entry came first. Claims that have run out, and earlier ones of
        the same batch, end with this one.
        """
        made: dict = {}

        def make(state: State) -> dict | None:
            made["id"] = uuid.uuid4().hex
            path = f"{self.root}/claims/claim={made['id']}"
            choose(state).select(*CLAIMED_SCHEMA.fieldNames()).write.parquet(path)
            made["files"] = self.spark.read.schema(CLAIMED_SCHEMA).parquet(path)
            made["n"] = made["files"].count()
            if not made["n"] and not empty:
                return None
            now = time.time()
            instead = [n for n, c in state.active.items() if c["until"] < now or c["batch_id"] == batch_id]
            return {"kind": "claim", "id": made["id"], "batch_id": batch_id, "n_files": made["n"], "until": now + lease, "instead": instead}

        number = self.append(make)
        return None if number is None else Claim(self, number, batch_id, made["id"], made["files"], made["n"], lease)

    def held(self, state: State, batch_id: str) -> DataFrame:
        """(path, modified_at) of the files that other loads are at."""
        now = time.time()
        ids = [c["id"] for c in state.active.values() if c["until"] >= now and c["batch_id"] != batch_id]
        return self._claimed(ids).select("path", "modified_at")

    def _claimed(self, ids: list[str]) -> DataFrame:
        return self._parts("claims", ids, CLAIMED_SCHEMA)

    def _parts(self, table: str, ids: list[str], schema) -> DataFrame:
        """The named parts of a table with their ``claim``; lists no other part."""
        if not ids:
            return self.spark.createDataFrame([], schema).withColumn("claim", F.lit(None).cast("string"))
        base = f"{self.root}/{table}"
        named = T.StructType([*schema.fields, T.StructField("claim", T.StringType())])
        reader = self.spark.read.schema(named).option("basePath", base)
        return reader.parquet(*[f"{base}/claim={i}" for i in ids])

    # What was loaded --------------------------------------------------------------------------

    def _tail(self, state: State) -> DataFrame:
        """Files of the commits since the snapshot, without those put off to a later try."""
        files = self._claimed([c["id"] for c in state.commits])
        put_off = self._parts("retries", [c["id"] for c in state.commits if c["n_retries"]], RETRIES_SCHEMA)
        return files.join(put_off, ["claim", "path", "modified_at"], "left_anti").select(*LOADED_SCHEMA.fieldNames())

    def loaded(self, state: State) -> DataFrame:
        """(path, modified_at) of all files that are done with; segments are sorted by time, so a range of it skips the rest."""
        return self._segments(state.loaded, LOADED_SCHEMA).unionByName(self._tail(state))

    def retries(self, state: State) -> DataFrame:
        """Files put off, with their last try: (path, modified_at, attempt, due_at, reason)."""
        tail = self._parts("retries", [c["id"] for c in state.commits if c["n_retries"]], RETRIES_SCHEMA).drop("claim")
        rows = tail if state.retries is None else tail.unionByName(self.spark.read.schema(RETRIES_SCHEMA).parquet(state.retries))
        rest = [F.col(c) for c in RETRIES_SCHEMA.fieldNames()[1:]]
        last = rows.groupBy("path").agg(F.max(F.struct(*rest)).alias("last")).select("path", "last.*")
        done = self._tail(state).select(F.col("path").alias("done"), F.col("modified_at").alias("done_at"))
        # A file that was written anew and loaded since then is not tried again as it was.
        return last.join(done, (F.col("path") == F.col("done")) & (F.col("modified_at") <= F.col("done_at")), "left_anti")

    def has_retries(self, state: State) -> bool:
        return state.retries is not None or any(c["n_retries"] for c in state.commits)

    def commits(self, state: State) -> DataFrame:
        """One row per complete batch, with the number of its commit.

        Its size is known to Spark, as an Arrow table's is and that of rows in a Python list is not, so that a join with it
        is a broadcast one: sorted and merged, all rows of a batch would go through one task.
        """
        rows = {"rows_loaded": pa.int64(), "committed_at": pa.float64(), "attempt_id": pa.string(), "number": pa.int64()}
        tail = self.spark.createDataFrame(pa.table({n: pa.array([c[n] for c in state.commits], kind) for n, kind in rows.items()}))
        tail = tail.withColumn("committed_at", F.timestamp_seconds("committed_at")).withColumnRenamed("attempt_id", "batch_id").select(*COMMITS_SCHEMA.fieldNames())
        return self._segments(state.committed, COMMITS_SCHEMA).unionByName(tail) if state.committed else tail

    def _segments(self, segments: list[list], schema) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[path for path, _ in segments])

    # Snapshots ----------------------------------------------------------------------------------

    def compact(self, every: int) -> bool:
        """Writes a snapshot if there are ``every`` entries since the last one; others may do so at the same time."""
        state = self.refresh()
        if state.number - state.since < every:
            return False
        new = State(state.number, state.number, state.active)
        new.loaded = self._merged("loaded", state.loaded, self._tail(state), LOADED_SCHEMA, "modified_at")
        new.committed = self._merged("commits", state.committed, self.commits(State(commits=state.commits)), COMMITS_SCHEMA, "number")
        waiting = f"{self.root}/snapshots/retries-{uuid.uuid4().hex}"
        self.retries(state).write.parquet(waiting)
        new.retries = waiting if read_table(self.spark, waiting, RETRIES_SCHEMA).limit(1).count() else None
        name = f"snapshot-{new.number:012d}.json"
        self.objects.create(name, new.text())
        self.objects.replace(_LATEST, json.dumps({"snapshot": name}))
        with self._lock:
            self.state = new
        return True

    def _merged(self, what: str, segments: list[list], tail: DataFrame, schema, order: str) -> list[list]:
        """The segments with one more for the tail, which takes up those that are not much larger than it."""
        segments, rows = list(segments), tail
        n = tail.count()
        if not n:
            return segments
        while segments and segments[-1][1] < _RATIO * n:
            path, more = segments.pop()
            rows, n = rows.unionByName(self.spark.read.schema(schema).parquet(path)), n + more
        path = f"{self.root}/snapshots/{what}-{uuid.uuid4().hex}"
        rows.repartitionByRange(order).sortWithinPartitions(order).write.parquet(path)
        return [*segments, [path, n]]


@dataclass
class Claim:
    """Files held by a load: ``files`` (``CLAIMED_SCHEMA``), and what the folders of this attempt are named by."""

    ledger: Ledger
    number: int
    batch_id: str
    id: str
    files: DataFrame
    n_files: int
    lease: float
    _stop: threading.Event = field(default_factory=threading.Event)

    @property
    def attempt_id(self) -> str:
        return f"{self.batch_id}.{self.number}"

    @property
    def retries_path(self) -> str:
        return f"{self.ledger.root}/retries/claim={self.id}"

    def _held(self, state: State) -> None:
        if self.number not in state.active:
            raise ClaimLost(f"the claim of {self.attempt_id} is not held any more")

    def keep(self) -> None:
        """Extends the claim from a thread of its own until it ends."""

        def extend() -> None:
            while not self._stop.wait(self.lease / 3):
                try:
                    self.ledger.append(lambda s: {"kind": "extend", "claim": self.number, "until": time.time() + self.lease} if self.number in s.active else None)
                except Exception:  # the next turn tries again; if none succeeds, the claim runs out
                    continue

        threading.Thread(target=extend, daemon=True, name=f"claim-{self.number}").start()

    def commit(self, rows_loaded: int, n_retries: int) -> None:
        """Makes the attempt's rows visible; raises ``ClaimLost`` if the claim is not held."""
        self._stop.set()

        def make(state: State) -> dict:
            self._held(state)
            return {
                "kind": "commit", "claim": self.number, "attempt_id": self.attempt_id, "rows_loaded": rows_loaded,
                "n_retries": n_retries, "committed_at": time.time(),
            }

        self.ledger.append(make)

    def release(self) -> None:
        """Gives the files back to others."""
        self._stop.set()
        self.ledger.append(lambda s: {"kind": "release", "claim": self.number} if self.number in s.active else None)
