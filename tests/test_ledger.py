"""Claims, snapshots and retries."""

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_ingest import HEADERS, inbox, line, put, store  # noqa: F401

from tillbook.schema import CLAIMED_SCHEMA, FILES_SCHEMA, RETRIES_SCHEMA, SALES_FIELDS
from tillbook.sources import ledger as ledger_module
from tillbook.sources.ledger import ClaimLost, Ledger
from tillbook.sources.objects import HadoopObjects, LocalObjects, objects
from tillbook.sources.workbook import open_file, scan_workbooks
from tillbook.streaming.ingest import SalesStore, append_batch, ingest_files, ingest_folder

DAY = datetime(2024, 1, 1)


@pytest.fixture(params=["local", "hadoop"])
def small_objects(request, spark, tmp_path):
    return LocalObjects(str(tmp_path)) if request.param == "local" else HadoopObjects(spark, f"file://{tmp_path}/deep")


def test_objects(small_objects):
    assert small_objects.read("a") is None
    assert small_objects.create("a", "é1") and not small_objects.create("a", "2")
    assert small_objects.read("a") == "é1"
    small_objects.replace("a", "3")
    assert small_objects.read("a") == "3"


def test_objects_are_created_once(tmp_path):
    won = []
    folder = LocalObjects(f"file://{tmp_path}/x")
    for n in range(20):
        threads = [threading.Thread(target=lambda i=i, n=n: folder.create(f"{n}", f"{i}") and won.append((n, i))) for i in range(8)]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    assert sorted(n for n, _ in won) == list(range(20))
    assert all(folder.read(f"{n}") == f"{i}" for n, i in won)


def test_kind_of_objects(spark, tmp_path):
    assert isinstance(objects(spark, str(tmp_path)), LocalObjects)
    assert isinstance(objects(spark, f"file://{tmp_path}"), LocalObjects)


def names(df):
    return sorted(r.path for r in df.collect())


def claimable(spark, ledger, paths, batch_id):
    files = spark.createDataFrame([(p, DAY + timedelta(days=len(p)), 1) for p in paths], CLAIMED_SCHEMA)
    same = ["path", "modified_at"]
    return lambda state: files.join(ledger.loaded(state), same, "left_anti").join(ledger.held(state, batch_id), same, "left_anti")


def claim(spark, ledger, paths, batch_id, lease=60.0):
    return ledger.claim(batch_id, lease, claimable(spark, ledger, paths, batch_id))


def test_claims_keep_loads_apart(spark, tmp_path):
    one, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    first = claim(spark, one, ["a", "b"], "one")
    second = claim(spark, other, ["a", "b", "c"], "other")
    assert names(first.files) == ["a", "b"] and names(second.files) == ["c"]
    assert claim(spark, other, ["a"], "third") is None
    first.commit(5, 0)
    second.release()
    third = claim(spark, other, ["a", "b", "c"], "third")
    assert names(third.files) == ["c"]
    with pytest.raises(ClaimLost):
        second.commit(1, 0)
    third.commit(1, 0)
    assert claim(spark, one, ["a", "b", "c"], "fourth") is None
    rows = {r.batch_id: r.rows_loaded for r in one.commits(one.state).collect()}
    assert rows == {first.attempt_id: 5, third.attempt_id: 1}


def test_a_claim_that_ran_out_is_taken_over_and_cannot_commit(spark, tmp_path):
    one, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    dead = claim(spark, one, ["a", "b"], "one", lease=0.1)
    time.sleep(0.2)
    heir = claim(spark, other, ["a"], "other")
    assert names(heir.files) == ["a"] and heir.number > dead.number
    with pytest.raises(ClaimLost):
        dead.commit(9, 0)
    heir.commit(1, 0)
    assert names(one.loaded(one.refresh())) == ["a"]


def test_a_kept_claim_does_not_run_out(spark, tmp_path):
    one, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    held = claim(spark, one, ["a"], "one", lease=3.0)
    held.keep()
    time.sleep(5)
    assert claim(spark, other, ["a"], "other") is None
    held.commit(1, 0)


def test_a_batch_that_is_begun_again_replaces_its_claim(spark, tmp_path):
    one, again = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    old = claim(spark, one, ["a"], "epoch-7")
    new = claim(spark, again, ["a"], "epoch-7")
    with pytest.raises(ClaimLost):
        old.commit(1, 0)
    new.commit(1, 0)
    assert old.attempt_id != new.attempt_id


def test_what_a_load_reads_does_not_grow(spark, tmp_path, monkeypatch):
    """200 batches by bare entries: a new load reads one snapshot and the entries since, and lists few files."""

    class Counting(LocalObjects):
        reads = 0

        def read(self, name):
            Counting.reads += 1
            return super().read(name)

    ledger = Ledger(spark, str(tmp_path))
    every, most = 20, {}
    for n in range(200):
        held = claim(spark, ledger, [f"f{n:03d}"], f"b{n}") if n % 20 == 0 else None
        if held is None:  # the same without Spark jobs
            number = ledger.append(lambda s, n=n: {"kind": "claim", "id": "none", "batch_id": f"b{n}", "n_files": 0, "until": 9e9, "instead": []})
            ledger.append(lambda s, number=number, n=n: {"kind": "release", "claim": number})
        else:
            held.commit(1, 0)
        ledger.compact(every)
        if n % 20 == 19:
            Counting.reads = 0
            monkeypatch.setattr(ledger_module, "objects", lambda _, folder: Counting(folder))
            fresh = Ledger(spark, str(tmp_path))
            monkeypatch.undo()
            most[n] = (Counting.reads - 3, len(fresh.loaded(fresh.state).inputFiles()), len(fresh.state.loaded), len(fresh.state.committed))
    assert all(tail <= 2 * every and files <= 8 and segments <= 4 and commits <= 4 for tail, files, segments, commits in most.values())
    assert names(ledger.loaded(ledger.state)) == [f"f{n:03d}" for n in range(0, 200, 20)]
    assert ledger.commits(ledger.state).count() == 10


def test_retries_last_through_snapshots(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    held = claim(spark, ledger, ["a", "b"], "one")
    rows = [("a", DAY + timedelta(days=1), 1, DAY, "busy")]
    spark.createDataFrame(rows, RETRIES_SCHEMA).write.parquet(held.retries_path)
    held.commit(1, 1)
    for _ in range(2):
        assert names(ledger.loaded(ledger.state)) == ["b"]
        assert [(r.path, r.attempt) for r in ledger.retries(ledger.state).collect()] == [("a", 1)]
        assert Ledger(spark, str(tmp_path)).has_retries(ledger.state)
        ledger.compact(1)
    claim(spark, ledger, ["a"], "two").commit(1, 0)
    for _ in range(2):
        assert names(ledger.loaded(ledger.state)) == ["a", "b"] and ledger.retries(ledger.state).count() == 0
        ledger.compact(1)
    assert not ledger.has_retries(ledger.state)


def busy(folder, failures):
    """Opens a file after so many failures; counts them beside it."""

    def opener(path):
        tries = folder / "tries"
        tries.mkdir(exist_ok=True)
        name = path.rsplit("/", 1)[1]
        done = len(list(tries.glob(f"{name}-*")))
        if done < failures.get(name, 0):
            (tries / f"{name}-{done}").touch()
            raise TimeoutError("no answer")
        return open_file(path)

    return opener


def test_storage_errors_are_tried_again(spark, inbox, tmp_path):  # noqa: F811
    for i, name in enumerate(("good", "third", "never")):
        put(inbox, f"{name}.xlsx", rows=[line(i)])
    (inbox / "broken.xlsx").write_bytes(b"nothing")
    opener = busy(tmp_path, {"third.xlsx": 2, "never.xlsx": 99})
    store = SalesStore(str(tmp_path / "store"), tries=4, retry_seconds=0.1, opener=opener)  # noqa: F811
    assert ingest_folder(spark, str(inbox), store) == 2
    assert sorted(r.customer_name for r in store.sales(spark).collect()) == ["C0", "C1"]
    events = {(r.source_file, r.event): r["count"] for r in store.ingest_log(spark).groupBy("source_file", "event").count().collect()}
    assert events[("third.xlsx", "postponed")] == 2 and events[("third.xlsx", "success")] == 1
    assert events[("never.xlsx", "postponed")] == 3 and events[("never.xlsx", "corrupted")] == 1
    assert ("broken.xlsx", "postponed") not in events and events[("broken.xlsx", "failure")] == 1
    reasons = {r.source_file: r.message for r in store.ingest_log(spark).filter("event = 'failure'").collect()}
    assert reasons["never.xlsx"].startswith("Not readable from storage (TimeoutError")
    assert ingest_folder(spark, str(inbox), store) == 0


def test_unknown_schemes_fail_the_job_and_reject_nothing(spark, store):  # noqa: F811
    files = spark.createDataFrame([("wasbs://box@account/a.xlsx", DAY)], FILES_SCHEMA)
    with pytest.raises(ValueError, match="wasbs"):
        ingest_files(files, store, "b1")
    assert store.quarantine(spark).count() == 0 and store.ingest_log(spark).filter("event <> 'detected'").count() == 0
    ledger = store.ledger(spark)
    assert not ledger.state.active and ledger.loaded(ledger.state).count() == 0
    landing = scan_workbooks(files, opener=lambda path: open_file("/nowhere"))  # an opener of one's own knows them
    assert "FileNotFoundError" in landing.first().error


def test_a_second_job_leaves_a_running_batch_alone(spark, inbox, store):  # noqa: F811
    for i in range(4):
        put(inbox, f"f{i}.xlsx", rows=[line(i)])
    inner = []

    class Interrupted(SalesStore):
        def path(self, table):
            if table.startswith("file_report") and not inner:
                inner.append(0)
                inner[0] = ingest_folder(spark, str(inbox), SalesStore(self.root))
            return super().path(table)

    outer = ingest_folder(spark, str(inbox), Interrupted(store.root), files_per_round=2)
    assert outer + inner[0] == 4 and inner[0] == 2
    assert sorted(r.customer_name for r in store.sales(spark).collect()) == ["C0", "C1", "C2", "C3"]
    assert store.ingest_log(spark).filter("event = 'detected'").count() == 4


def test_a_load_that_was_taken_for_dead_adds_nothing(spark, inbox, tmp_path):  # noqa: F811
    put(inbox, "a.xlsx", rows=[line(1)])
    root = str(tmp_path / "store")
    turns = []

    class Slow(SalesStore):
        def path(self, table):
            if table.startswith("file_report") and not turns:
                turns.append(1)
                ledger = self.ledger(spark)  # its claim runs out, as if the driver had been silent
                for number in list(ledger.state.active):
                    ledger.append(lambda s, number=number: {"kind": "extend", "claim": number, "until": 0.0})
                assert ingest_folder(spark, str(inbox), SalesStore(root)) == 1
            return super().path(table)

    with pytest.raises(ClaimLost):
        ingest_folder(spark, str(inbox), Slow(root))
    assert SalesStore(root).sales(spark).count() == 1
    assert SalesStore(root).ingest_log(spark).groupBy("event").count().filter(F.col("count") > 1).count() == 0


def test_sales_of_committed_batches_are_not_sorted_to_find_them(spark, tmp_path):
    """However few batches there are, and whether or not there is a snapshot: the rows of a batch do not meet in one task."""
    store = SalesStore(str(tmp_path))
    one = spark.createDataFrame([(DAY.date(), "C")], "sale_date date, customer_name string")
    rows = one.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in SALES_FIELDS if f.name not in one.columns])
    for n in range(3):
        append_batch(rows, store, f"b{n}")
        assert store.ledger(spark).compact(4) == (n == 1)
        sales = store.sales(spark)
        assert sales.count() == n + 1
        plan = sales._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
