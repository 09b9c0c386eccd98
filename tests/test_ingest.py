"""Workbook scan, batch ingest and streaming ingest."""

import io
import os
import time
import tracemalloc
import zipfile
from datetime import date, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbook.plans.dashboard import refresh
from tillbook.plans import sample_books
from tillbook.plans.sample_books import workbook_bytes, workbook_of
from tillbook.schema import CANONICAL_COLUMNS, FILES_SCHEMA
from tillbook.sources import workbook
from tillbook.sources.folder import workbook_files, workbook_stream
from tillbook.sources.staging import append_sales
from tillbook.sources.workbook import raw_files, raw_rows, scan_workbooks, sheet_rows
from tillbook.streaming import ingest
from tillbook.streaming.ingest import SalesStore, ingest_files, ingest_folder, start_ingest_stream

HEADERS = ["Sale Date", "Customar_Name", "City", "State", "Region", "Category", "Product", "Qty", "Price", "Total"]


def line(i=1, **changes):
    row = dict(zip(CANONICAL_COLUMNS, [date(2023, 1, 5), f"C{i}", "Pune", "MH", "West", "Toys", "Kite", 2, 1.5, 3.0]))
    return list({**row, **changes}.values())


def put(folder, name, headers=HEADERS, rows=None):
    (folder / name).write_bytes(workbook_bytes(headers, [line()] if rows is None else rows))


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    return folder


@pytest.fixture
def store(tmp_path):
    return SalesStore(str(tmp_path / "store"))


def parts(**texts):
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(workbook_bytes(["a"], [])), "r") as plain, zipfile.ZipFile(out, "w") as book:
        for name in plain.namelist():
            if name not in texts:
                book.writestr(name, plain.read(name))
        for name, text in texts.items():
            book.writestr(name, text)
    return out.getvalue()


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
SHEET = f"""<worksheet {NS}><sheetData><row/>
<row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row>
<row r="3"><c r="A3" s="1"><v>44929</v></c><c r="B3"><v>0.10000000000000001</v></c><c r="C3" t="b"><v>1</v></c></row>
<row r="4"><c r="A4" s="2"><v>44929.5</v></c><c r="C4" t="str"><f>A1</f><v>x</v></c><c r="AB4"><v>7</v></c></row>
<row r="5"><c r="A5" t="e"><v>#N/A</v></c><c r="C5" s="3"><v>12</v></c></row></sheetData></worksheet>"""
STRINGS = f"""<sst {NS}><si><t>When</t></si><si><r><t>Wh</t></r><r><t>at</t></r><rPh><t>no</t></rPh></si></sst>"""
STYLES = f"""<styleSheet {NS}><numFmts><numFmt numFmtId="164" formatCode="dd\\-mm\\-yyyy hh:mm"/>
<numFmt numFmtId="165" formatCode="&quot;days&quot; 0.0"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>
<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>"""


def test_cell_kinds():
    content = parts(**{"xl/worksheets/sheet1.xml": SHEET, "xl/sharedStrings.xml": STRINGS, "xl/styles.xml": STYLES})
    rows = list(sheet_rows(io.BytesIO(content)))
    assert rows[0] == ["When", None, "What"]
    assert rows[1] == ["2023-01-03", "0.1", "true"]
    assert rows[2] == ["2023-01-03 12:00:00", None, "x"] + [None] * 24 + ["7"]
    assert rows[3] == ["#N/A", None, "12"]


@pytest.mark.parametrize("bound, grows", [(1 << 30, True), (1 << 16, False)])
def test_shared_strings_beyond_the_bound(monkeypatch, bound, grows):
    """The same rows from a table in files, and memory that does not grow with it."""
    monkeypatch.setattr(workbook, "STRING_BYTES", bound)
    held = []
    for n in (60_000, 180_000):
        texts = [f"é{i} " + "x" * (i % 50) for i in range(n)]
        strings = f"<sst {NS}>" + "".join(f"<si><t xml:space='preserve'>{t}</t></si>" for t in texts) + "</sst>"
        order = [(i * 7919) % n for i in range(n)]
        cells = "".join(f'<row><c t="s"><v>{i}</v></c><c t="s"><v>{j}</v></c></row>' for i, j in enumerate(order))
        book = io.BytesIO(parts(**{"xl/worksheets/sheet1.xml": f"<worksheet {NS}><sheetData>{cells}</sheetData></worksheet>", "xl/sharedStrings.xml": strings}))
        del strings, cells
        tracemalloc.start()
        for i, row in enumerate(sheet_rows(book)):
            assert row == [texts[i], texts[order[i]]]
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert (held[1] - held[0] > 8e6) == grows, held


ROWS = [
    '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2" s="1"><v>44929</v></c></row>',
    '<row><c t="inlineStr"><is><t xml:space="preserve"> a &lt;b&gt; &amp;amp; </t></is></c><c/><c s="1"><v>44929.5</v></c></row>',
    '<row spans="1:3">\n<c t="b"><v>1</v></c><c t="str"><v>&quot;x&apos;</v></c><c><v>0.10000000000000001</v></c></row>',
    '<row><c t="inlineStr"><is><t></t></is></c><c t="inlineStr"/><c t="e"><v>#N/A</v></c><c><is><t>1</t></is></c></row>',
    '<row r="9" other="1"><c r="B9"><f>A1</f><v>7</v></c></row>',
    '<row><c><v>1</v><!-- x --></c><c t="str"><v>a\r\nb</v></c><c t="str"><v>&#65;</v></c></row>',
]


@pytest.mark.parametrize("content", [*ROWS, "".join(ROWS[:4]), "".join(ROWS), "<row><c><v>&amp;</v></c></row>"])
def test_plain_rows_read_like_parsed_ones(content):
    args = (["zero", "a&b"], {1}, datetime(1899, 12, 30))
    head = f"<worksheet {NS}><sheetData>".encode()

    def cells(rows):
        try:
            return list(rows)
        except ValueError as problem:
            return str(problem)

    parsed = cells(workbook._parsed_rows(workbook.ElementTree.fromstring(head + content.encode() + b"</sheetData></worksheet>")[-1], *args))
    plain = workbook._PlainRows(*args).rows(head, content.encode())
    if any(odd in content for odd in ROWS[4:]):
        assert plain is None
    else:
        assert cells(plain) == parsed


@pytest.mark.parametrize("text", ["a]]>b", "&x;", "a\x01b", "\ufffe"])
def test_what_is_no_xml_is_left_to_the_parser(text):
    content = f"<row><c t='str'><v>{text}</v></c></row>".replace("'", '"').encode()
    assert workbook._PlainRows([], set(), datetime(1899, 12, 30)).rows(f"<worksheet {NS}><sheetData>".encode(), content) is None


def test_workbooks_of_rows_are_read_without_a_parser(monkeypatch):
    rows = pa.RecordBatch.from_pylist([{"day": date(2023, 1, 5), "name": "A & <B>", "n": 2, "x": 0.1, "none": None}] * 3)
    monkeypatch.setattr(workbook, "_parsed_rows", None)
    expected = [["day", "name", "n", "x", "none"], *[["2023-01-05", "A & <B>", "2", "0.1", None]] * 3]
    assert list(sheet_rows(io.BytesIO(workbook_of(rows)))) == expected
    assert list(sheet_rows(io.BytesIO(workbook_bytes(rows.schema.names, [r.values() for r in rows.to_pylist()])))) == expected


def test_a_number_that_comes_again_is_read_once(monkeypatch):
    seen, number_text = [], workbook._number_text
    monkeypatch.setattr(workbook, "_number_text", lambda v: seen.append(v) or number_text(v))
    book = io.BytesIO(workbook_bytes(["a", "b"], [[i % 3, 0.25] for i in range(5_000)]))
    assert list(sheet_rows(book))[1:] == [[str(i % 3), "0.25"] for i in range(5_000)]
    assert len(seen) < 50


def test_rows_of_many_widths_and_places():
    """Rows with named places, gaps, blanks and entities, in slices of both kinds, are cut and padded to the headed columns."""
    rows = ['<row><c t="str"><v>x</v></c><c/><c t="str"><v>y</v></c></row>', '<row r="2"><c r="C2"><v>1</v></c><c><v>9</v></c></row>',
            '<row><c/></row>', '<row/>', '<row><c r="B4" t="str"><v>lost</v></c></row>', '<row><c t="str"><v>&lt;&amp;lt;</v></c></row>']
    plain = [r for r in rows if r != "<row/>"]
    for lines in (rows, plain):
        book = io.BytesIO(parts(**{"xl/worksheets/sheet1.xml": f"<worksheet {NS}><sheetData>{''.join(lines)}</sheetData></worksheet>"}))
        batches = list(workbook._decode_file("in/a.xlsx", None, lambda _: book))
        assert [c for b in batches[:-1] for c in b.column("cells").to_pylist()] == [[None, "1"], [None, None], ["<&lt;", None]]
        assert batches[-1].column("cells").to_pylist() == [["x", "y"]] and batches[-1].column("rows_read").to_pylist() == [3]
    assert workbook._PlainRows([], set(), datetime(1899, 12, 30)).table(f"<worksheet {NS}><sheetData>".encode(), "".join(plain).encode()) is not None


def test_workbooks_are_made_column_by_column(monkeypatch):
    amounts = [0.0, -0.0, 1e-5, 0.1, 5.0, 1e10, 1e22, float("nan"), 123456.78]
    made, cell = [], sample_books._cell
    monkeypatch.setattr(sample_books, "_cell", lambda v: made.append(v) or cell(v))
    for values in (amounts, [None, *amounts], [0.1, 5.0, -123456.78] * 2_000):
        made.clear()
        batch = pa.RecordBatch.from_pydict({"x": pa.array(values, pa.float64()), "n": [7] * len(values), "s": ["a<b"] * len(values)})
        books = workbook_of(batch), workbook_bytes(batch.schema.names, [r.values() for r in batch.to_pylist()])
        sheets = [zipfile.ZipFile(io.BytesIO(b)).read("xl/worksheets/sheet1.xml") for b in books]
        assert sheets[0] == sheets[1] and len(sheets[0]) > 20 * len(values)
        made.clear()
        workbook_of(batch)
        assert len(made) < 50


def test_1904_calendar():
    book = parts(**{"xl/worksheets/sheet1.xml": SHEET, "xl/sharedStrings.xml": STRINGS, "xl/styles.xml": STYLES,
                    "xl/workbook.xml": zipfile.ZipFile(io.BytesIO(workbook_bytes(["a"], []))).read("xl/workbook.xml")
                    .decode().replace("<sheets>", '<workbookPr date1904="1"/><sheets>')})
    assert list(sheet_rows(io.BytesIO(book)))[1][0] == "2027-01-04"


def test_scan(spark, inbox):
    put(inbox, "b [1] x%20.xlsx", ["A", "", "B"], [["v", "lost", 1.25], [None, None, None], [date(2024, 2, 29), "", 7]])
    (inbox / "old.XLS").write_bytes(b"\xd0\xcf\x11\xe0 legacy")
    (inbox / "cut.Xlsm").write_bytes(workbook_bytes(["A"], [[i] for i in range(900)])[:-900])
    (inbox / "notes.txt").write_text("x")
    (inbox / "data.xlsb").write_bytes(b"x")
    (inbox / "sub").mkdir()
    put(inbox / "sub", "deep.xlsx")
    (inbox / "part=1").mkdir()
    put(inbox / "part=1", "deep.xlsx")
    put(inbox, "gone.xlsx")
    listed = workbook_files(spark, str(inbox)).collect()
    (inbox / "gone.xlsx").unlink()
    landing = scan_workbooks(spark.createDataFrame(listed, FILES_SCHEMA)).cache()
    files = {r.source_file: r for r in raw_files(landing).collect()}
    assert set(files) == {"b [1] x%20.xlsx", "old.XLS", "cut.Xlsm", "gone.xlsx"}
    assert "FileNotFoundError" in files["gone.xlsx"].error
    assert files["b [1] x%20.xlsx"].rows_read == 2 and files["b [1] x%20.xlsx"].seconds >= 0
    assert files["b [1] x%20.xlsx"].headers == ["A", "B"] and files["b [1] x%20.xlsx"].error is None
    assert files["old.XLS"].error.startswith("Not readable as a workbook (BadZipFile")
    assert files["cut.Xlsm"].error is not None
    rows = raw_rows(landing).filter("source_file LIKE 'b%'").orderBy("row_no").collect()
    assert [r.cells for r in rows] == [["v", "1.25"], ["2024-02-29", "7"]]


def fill(inbox):
    put(inbox, "good.xlsx", HEADERS + ["Extra"], [line(1) + ["x"], line(2, sales_amount="1,234.50") + ["y"],
                                                 line(3, customer_name=None) + ["z"]])
    put(inbox, "serial.xlsm", rows=[line(4, sale_date="44929"), line(5, sale_date="44930.4")])
    put(inbox, "missing.xlsx", HEADERS[:-1], [line()[:-1]])
    put(inbox, "double.xlsx", HEADERS + ["Revenue"], [line() + [1]])
    put(inbox, "bare.xlsx", rows=[])
    put(inbox, "undated.xlsx", rows=[line(sale_date="soon"), line(sale_date="later")])
    (inbox / "broken.xlsx").write_bytes(b"nothing")


def outcome(spark, store):
    log = store.ingest_log(spark)
    return {r.source_file: r for r in log.filter("event IN ('success', 'failure')").collect()}


def check_filled(spark, store):
    sales = store.sales(spark)
    assert sales.count() == 4
    assert {r.source_file for r in sales.collect()} == {"good.xlsx", "serial.xlsm"}
    assert sales.filter("customer_name = 'C4'").first().sale_date == date(2023, 1, 3)
    assert sales.filter("customer_name = 'C2'").first().sales_amount == 1234.5
    done = outcome(spark, store)
    assert {f for f, r in done.items() if r.event == "success"} == {"good.xlsx", "serial.xlsm"}
    good = done["good.xlsx"]
    assert (good.rows_read, good.columns_read, good.rows_loaded, good.rows_dropped) == (3, 11, 2, 1)
    assert good.disposition == "processed" and good.target_name.endswith("_good.xlsx") and good.seconds >= 0
    assert len(good.target_name) == len("20240101_000000_good.xlsx")
    reasons = {"missing.xlsx": "No column found for sales_amount", "double.xlsx": "Several headers",
               "bare.xlsx": "The sheet has headers only", "undated.xlsx": "Each row lacks",
               "broken.xlsx": "Not readable as a workbook"}
    for name, start in reasons.items():
        assert done[name].message.startswith(start) and done[name].disposition == "failed"
    events = store.ingest_log(spark).groupBy("event").count().collect()
    assert {r.event: r["count"] for r in events} == {"detected": 7, "success": 2, "failure": 5, "corrupted": 5}
    held = store.quarantine(spark).groupBy("source_file").count().collect()
    assert {r.source_file: r["count"] for r in held} == {"missing.xlsx": 1, "double.xlsx": 1, "undated.xlsx": 2}


def test_batch(spark, inbox, store):
    fill(inbox)
    assert ingest_folder(spark, str(inbox), store) == 4
    check_filled(spark, store)
    assert ingest_folder(spark, str(inbox), store) == 0  # nothing new
    put(inbox, "late.xlsx", rows=[line(7), line(8)])
    put(inbox, "bare.xlsx", rows=[line(9)])  # put back, now with a row
    assert ingest_folder(spark, str(inbox), store) == 3
    assert store.sales(spark).count() == 7
    panels = refresh(spark, store)
    assert panels["kpis"].first().total_transactions == 7
    assert panels["file_statistics"].count() == 4


def test_rounds(spark, inbox, store):
    for i in range(3):
        put(inbox, f"f{i}.xlsx", rows=[line(i)])
    assert ingest_folder(spark, str(inbox), store, files_per_round=2) == 3
    assert store.commits(spark).count() == 2
    assert store.sales(spark).select("source_file").distinct().count() == 3


def test_repeated_batch_replaces_itself(spark, inbox, store):
    fill(inbox)
    for _ in range(2):
        ingest_files(workbook_files(spark, str(inbox)), store, "b1")
    check_filled(spark, store)


def test_long_messages_are_cut(spark, inbox, store):
    put(inbox, "wide.xlsx", [f"column {i} with a long name" for i in range(60)], [["x"] * 60])
    ingest_folder(spark, str(inbox), store)
    sizes = {r.event: len(r.message) for r in store.ingest_log(spark).filter("message IS NOT NULL").collect()}
    assert sizes == {"failure": 600, "corrupted": 400}


def run_stream(spark, inbox, store, tmp_path, **options):
    files = workbook_stream(spark, str(inbox), **options)
    start_ingest_stream(files, store, str(tmp_path / "checkpoint"), available_now=True).awaitTermination()


def test_stream(spark, inbox, store, tmp_path):
    fill(inbox)
    (inbox / "notes.txt").write_text("x")
    (inbox / "sub").mkdir()
    put(inbox / "sub", "deep.xlsx")
    run_stream(spark, inbox, store, tmp_path)
    check_filled(spark, store)
    run_stream(spark, inbox, store, tmp_path)  # a restart reads no file twice
    check_filled(spark, store)
    put(inbox, "late.xlsx", rows=[line(7)])
    run_stream(spark, inbox, store, tmp_path)
    assert store.sales(spark).count() == 5


def test_stream_file_after_file(spark, inbox, store, tmp_path):
    for i in range(2):
        put(inbox, f"f{i}.xlsx", rows=[line(i)])
    run_stream(spark, inbox, store, tmp_path, files_per_trigger=1)
    batches = store.sales(spark).groupBy("batch_id").agg(F.count_distinct("source_file").alias("n")).collect()
    assert [r.n for r in batches] == [1, 1]
    assert store.sales(spark).agg(F.max("loaded_at")).first()[0] > datetime(2024, 1, 1)


def test_batch_then_stream_loads_once(spark, inbox, store, tmp_path):
    fill(inbox)
    assert ingest_folder(spark, str(inbox), store) == 4
    run_stream(spark, inbox, store, tmp_path)
    check_filled(spark, store)


def test_two_streams_keep_apart(spark, inbox, store, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    put(inbox, "a.xlsx", rows=[line(1)])
    put(other, "a.xlsx", rows=[line(2)])
    for i, folder in enumerate((inbox, other, inbox)):
        files = workbook_stream(spark, str(folder))
        start_ingest_stream(files, store, str(tmp_path / f"checkpoint{i}"), available_now=True).awaitTermination()
    assert sorted(r.customer_name for r in store.sales(spark).collect()) == ["C1", "C2"]


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["landing", "staging_sales", "file_report", "commits"])
def test_a_stopped_batch_is_finished(spark, inbox, store, step):
    class Stopping(SalesStore):
        def path(self, table):
            if table.split("/")[0] == step:
                raise Stopped
            return super().path(table)

    fill(inbox)
    if step == "commits":  # the last step of all
        real = ingest.commit
        ingest.commit = lambda *a: (_ for _ in ()).throw(Stopped())
        try:
            with pytest.raises(Stopped):
                ingest_folder(spark, str(inbox), store)
        finally:
            ingest.commit = real
    else:
        with pytest.raises(Stopped):
            ingest_folder(spark, str(inbox), Stopping(store.root))
    assert store.sales(spark).count() == 0  # not committed, so not seen
    assert store.ingest_log(spark).filter("event = 'detected'").count() == 7
    assert ingest_folder(spark, str(inbox), store) == 4
    check_filled(spark, store)


def test_a_stopped_batch_leaves_its_log_only(spark, inbox, store):
    class Stopping(SalesStore):
        def path(self, table):
            if table.split("/")[0] == "file_report":
                raise Stopped
            return super().path(table)

    fill(inbox)
    with pytest.raises(Stopped):
        ingest_folder(spark, str(inbox), Stopping(store.root))
    left = {t: [d for d in os.listdir(f"{store.root}/{t}") if d.startswith("batch_id=")] for t in os.listdir(store.root)}
    assert {t for t, batches in left.items() if batches} == {"ingest_log"}
    assert ingest_folder(spark, str(inbox), store) == 4
    check_filled(spark, store)


def test_writes_give_back_their_shuffles(spark, store):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def held():
        paths = [os.path.join(at, n) for f in folders for at, _, names in os.walk(f.getPath()) for n in names if n.startswith("shuffle_")]
        return sum(os.path.getsize(p) for p in paths if os.path.exists(p))

    before = held()
    empty = [f"CAST(NULL AS {t}) AS {c}" for c, t in zip(CANONICAL_COLUMNS[2:], ["string"] * 5 + ["int"] + ["double"] * 2, strict=True)]
    rows = spark.range(20_000).selectExpr("date_add(DATE'2023-01-01', CAST(id % 90 AS INT)) AS sale_date", "uuid() AS customer_name", *empty, "'a.xlsx' AS source_file")
    assert append_sales(rows, f"{store.root}/staging_sales", "b1") == 20_000
    until = time.time() + 20
    while held() > before + 100_000 and time.time() < until:
        time.sleep(0.2)
    assert held() <= before + 100_000


def test_rejected_files_without_rows_need_no_quarantine(spark, inbox, store):
    put(inbox, "bare.xlsx", rows=[])
    (inbox / "broken.xlsx").write_bytes(b"nothing")
    put(inbox, "good.xlsx")
    assert ingest_folder(spark, str(inbox), store) == 1
    assert store.quarantine(spark).count() == 0
    assert not os.path.exists(f"{store.root}/quarantine")


def test_files_of_one_name_in_two_folders(spark, inbox, store, tmp_path):
    other = tmp_path / "other"
    other.mkdir()
    put(inbox, "a.xlsx", rows=[line(1)])
    put(other, "a.xlsx", [h.upper() for h in reversed(HEADERS)], [list(reversed(line(2)))])
    both = workbook_files(spark, str(inbox)).union(workbook_files(spark, str(other)))
    assert ingest_files(both, store, "b1") == 2
    assert sorted(r.customer_name for r in store.sales(spark).collect()) == ["C1", "C2"]


def test_old_files_are_loaded(spark, inbox, store, tmp_path):
    put(inbox, "new.xlsx", rows=[line(1)])
    run_stream(spark, inbox, store, tmp_path)
    put(inbox, "old.xlsx", rows=[line(2)])
    month_ago = time.time() - 30 * 86_400
    os.utime(inbox / "old.xlsx", (month_ago, month_ago))
    run_stream(spark, inbox, store, tmp_path)
    assert store.sales(spark).count() == 2


def test_empty_folder(spark, inbox, store):
    assert ingest_folder(spark, str(inbox), store) == 0
    assert store.sales(spark).count() == 0
