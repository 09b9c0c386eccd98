"""Cell conversions and row rules."""

from datetime import date

from pyspark.sql import functions as F

from tillbook.functions import text
from tillbook.operators.cleaning import CleaningOptions, add_date_mode, clean, standardise
from tillbook.operators.headers import plan_files
from tillbook.operators.verdict import NO_ROWS, NONE_VALID, count_rows, file_report, rejected_rows
from tillbook.schema import CANONICAL_COLUMNS

BASE = {
    "sale_date": "2023-01-05", "customer_name": "Ann", "city": "Pune", "state": "MH", "region": "West",
    "product_category": "Toys", "product_name": "Kite", "quantity": "2", "price_per_unit": "1.5",
    "sales_amount": "3",
}


def tables(spark, rows, file="f.xlsx"):
    """Raw files and rows from dicts of changed cells, or (file, dict) pairs."""
    pairs = [r if isinstance(r, tuple) else (file, r) for r in rows]
    raw = [
        (f, i, [{**BASE, "product_name": f"{i:03d}", **r}[c] for c in CANONICAL_COLUMNS])
        for i, (f, r) in enumerate(pairs, 1)
    ]
    names = sorted({f for f, _, _ in raw})
    files = [(f"in/{f}", f, list(CANONICAL_COLUMNS), None) for f in names]
    return (
        spark.createDataFrame(files, "path string, source_file string, headers array<string>, error string"),
        spark.createDataFrame([(f"in/{f}", f, *r) for f, *r in raw], "path string, source_file string, row_no long, cells array<string>"),
    )


def typed(spark, rows, options=CleaningOptions()):
    files, raw = tables(spark, rows)
    return standardise(raw, add_date_mode(plan_files(files), raw, options), options).orderBy("product_name").collect()


def dates(spark, values, options=CleaningOptions()):
    """Each value in a file of its own."""
    rows = typed(spark, [(f"f{i}", {"sale_date": v}) for i, v in enumerate(values)], options)
    return [r.sale_date for r in rows]


def column_dates(spark, values, options=CleaningOptions()):
    """All values in one file."""
    return [r.sale_date for r in typed(spark, [{"sale_date": v} for v in values], options)]


JAN5 = date(2023, 1, 5)


def test_text_dates(spark):
    values = ["2023-01-05", "05/01/2023", "01/25/2023", "25-01-2023", "2023-01-05 13:45:00", "2023-01-05T13:45:00",
              "2023-1-5", "31/02/2023", "soon", "2023", "", None, "44929", "2023-01-05 x", "05/01/23"]
    jan25 = date(2023, 1, 25)
    assert dates(spark, values) == [JAN5, JAN5, jan25, jan25, JAN5, JAN5, JAN5] + [None] * 5 + [
        date(2023, 1, 3), None, None]


def test_one_format_for_the_whole_column(spark):
    """Days and months do not change places within a file."""
    feb3, mar2, jan25 = date(2023, 2, 3), date(2023, 3, 2), date(2023, 1, 25)
    assert column_dates(spark, ["02/03/2023", "01/25/2023", None, "soon"]) == [feb3, jan25, None, None]
    assert column_dates(spark, ["02/03/2023", "25/01/2023"]) == [mar2, jan25]
    assert column_dates(spark, ["02/03/2023", "03/02/2023"]) == [mar2, feb3]  # either way: the earlier format
    assert column_dates(spark, ["2023-02-03", "02/03/2023", "01/25/2023", "01/26/2023"])[:3] == [feb3, feb3, jan25]
    assert column_dates(spark, ["2023-02-03", "2023-02-03 10:00:00", "02/03/2023"]) == [feb3, feb3, None]


def test_iso_only(spark):
    options = CleaningOptions(date_formats=("yyyy-MM-dd",), infer_dates=False)
    values = ["2023-01-05", "05/01/2023", "01/25/2023", "25-01-2023", "2023-1-5"]
    assert dates(spark, values, options) == [JAN5, None, None, None, None]


def test_other_format(spark):
    options = CleaningOptions(date_formats=("d MMM yyyy",), infer_dates=False)
    assert dates(spark, ["5 Jan 2023", "2023-01-05"], options) == [JAN5, None]


def test_serial_dates(spark):
    got = column_dates(spark, ["44929", "44929.7", " 44929 ", "1", "0.5", "-3", "2023-01-05", "abc", "2958465", "2958466",
                        "1e99", None, "nan"])
    assert got == [date(2023, 1, 3)] * 3 + [date(1899, 12, 31), None, None, None, None, date(9999, 12, 31),
                                            None, None, None, None]


def test_first_value_decides_per_file(spark):
    """30,000 and 65,000 are outside; later values and other files do not matter."""
    firsts = {"30000": False, "65000": False, "2023-01-05": False, "12": False, "30000.5": True, "64999": True}
    rows = [(f, {"sale_date": v}) for f in firsts for v in (None, f, "44929")]
    files, raw = tables(spark, rows)
    planned = {r.source_file: r.serial_dates for r in add_date_mode(plan_files(files), raw).collect()}
    assert planned == firsts
    typed = standardise(raw, add_date_mode(plan_files(files), raw)).filter("sale_date = DATE '2023-01-03'").collect()
    assert {r.source_file for r in typed} == {f for f, serial in firsts.items() if serial}


def test_quantity(spark):
    values = ["20", "20.0", "1,000", "abc", "3000000000", "-4", "2.5", "3.5", "", None, "-2.5", " 7"]
    rows = [{"quantity": v} for v in values]
    assert [r.quantity for r in typed(spark, rows)] == [20, 20, None, None, None, -4, 2, 4, None, None, -2, None]
    half_up = typed(spark, rows, CleaningOptions(quantity_half_even=False))
    assert [r.quantity for r in half_up][6:8] + [half_up[10].quantity] == [3, 4, -3]


def test_money(spark):
    values = [" 1,234.50 ", "1 234.50", "1\xa0234.5", "$12", "20d", "20f", "1e3", "-5", ".5", "5.", "", "nan",
              "Infinity", "1e300", "1.2.3", None]
    rows = typed(spark, [{"price_per_unit": v} for v in values])
    assert [r.price_per_unit for r in rows] == [1234.5, 1234.5, 1234.5, None, None, None, 1000.0, -5.0, 0.5, 5.0,
                                                None, None, None, 1e300, None, None]


def test_text(spark):
    rows = typed(spark, [{"city": v} for v in ["\tPune\xa0", "  ", "a b", None, "　x "]])
    assert [r.city for r in rows] == ["Pune", "", "a b", None, "x"]


def test_dropped_rows_and_report(spark):
    files, raw = tables(spark, [
        ("a", {}), ("a", {"sale_date": "soon"}), ("a", {"customer_name": None}), ("a", {"sales_amount": "$1"}),
        ("a", {"customer_name": "  "}), ("a", {"quantity": "x", "price_per_unit": "x", "city": None}),
        ("bad", {"sale_date": "soon"}),
    ])
    extra = spark.createDataFrame(
        [("in/empty", "empty", list(CANONICAL_COLUMNS), None), ("in/broken", "broken", [], "Cannot read"),
         ("in/short", "short", ["city"], None)],
        files.schema,
    )
    orphan = spark.createDataFrame([("in/short", "short", 1, ["x"])], raw.schema)
    every = raw.union(orphan)
    counted = files.union(extra).join(count_rows(every, "rows_read"), "path", "left")
    planned = add_date_mode(plan_files(counted), raw).cache()
    kept = clean(every, planned)
    report = {r.source_file: r for r in file_report(planned, count_rows(kept, "rows_kept")).collect()}
    assert (report["a"].rows_read, report["a"].rows_loaded, report["a"].rows_dropped) == (6, 3, 3)
    assert report["a"].reason is None
    assert report["bad"].reason == NONE_VALID
    assert report["empty"].reason == NO_ROWS
    assert report["broken"].reason == "Cannot read"
    assert report["short"].reason.startswith("No column found for sale_date, ")
    assert report["short"].rows_loaded == report["short"].rows_dropped == 0
    counts = list(report.values())
    rejected = rejected_rows(every, file_report(planned, count_rows(kept, "rows_kept"))).count()
    whole = sum(r.rows_loaded + r.rows_dropped for r in counts if r.reason is None) + rejected
    assert whole == every.count() == sum(r.rows_read for r in counts)


def test_short_rows_have_null_cells(spark):
    files, raw = tables(spark, [{}])
    cut = spark.createDataFrame([("in/f.xlsx", "f.xlsx", 2, ["2023-01-05", "Bob"])], raw.schema)
    both = raw.union(cut)
    rows = standardise(both, add_date_mode(plan_files(files), both)).filter("customer_name = 'Bob'").collect()
    assert len(rows) == 1 and rows[0].sales_amount is None


def test_usual_and_unusual_cells_agree(spark):
    """Cells at the border of the quick paths: line ends, exponents, long numbers, ISO dates that are none, other formats of that shape."""
    days = [{"sale_date": v} for v in ["2023-01-05", "2023-02-31", "2023-01-07\n", "2023-1-8", " 2023-01-09", None]]
    assert [r.sale_date for r in typed(spark, days)] == [date(2023, 1, 5), None, date(2023, 1, 7), date(2023, 1, 8), None, None]
    turned = CleaningOptions(date_formats=("yyyy-dd-MM", "yyyy-MM-dd"))
    assert [r.sale_date for r in typed(spark, [{"sale_date": v} for v in ["2023-05-01", "2023-06-01"]], turned)] == [date(2023, 1, 5), date(2023, 1, 6)]
    amounts = [{"sales_amount": v} for v in ["5.\n", "+7", "1e400", "9" * 310, "9" * 300, "1e2", "5d", "Infinity", ""]]
    assert [r.sales_amount for r in typed(spark, amounts)] == [5.0, 7.0, None, None, 1e300, 100.0, None, None, None]
    cities = [{"city": v} for v in ["!", "~", "\x7f", "a\u2028", "é b", "\u3000é", "a\x0b", "\x1fa"]]
    assert [r.city for r in typed(spark, cities)] == ["!", "~", "\x7f", "a", "é b", "é", "a", "\x1fa"]


def test_texts_without_space_around_are_not_searched(spark):
    plan = spark.range(1).select(text.strip(F.col("id").cast("string")).alias("v"))._jdf.queryExecution().analyzed().toString()
    assert "CASE WHEN" in plan and "trim" in plan.lower()
