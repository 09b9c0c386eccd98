"""DuckDB SQL that states what each registered query must return.

Written from the meaning of the queries, not from their Spark plans: amounts
are sums of decimals with 12 places, similarity is the textbook dynamic
program, and cleaning is checked by starting from the clean values.
"""

from __future__ import annotations

from tillbook.plans import untidy
from tillbook.schema import CANONICAL_COLUMNS, HEADER_ALIASES

_TABLES = """
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
         JOIN part ON l_partkey = p_partkey"""

SALES = f"""
  staging_sales AS (
    SELECT CAST(o_orderdate AS DATE) AS sale_date, c_name AS customer_name,
           CASE WHEN c_custkey % 97 = 0 THEN NULL
                ELSE n_name || '_C' || CAST(c_custkey % 4 AS VARCHAR) END AS city,
           n_name AS state,
           CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE r_name END AS region,
           p_type AS product_category, p_name AS product_name,
           CAST(l_quantity AS INT) AS quantity, p_retailprice AS price_per_unit,
           l_extendedprice * (1 - l_discount) AS sales_amount,
           'sales_' || CAST(year(o_orderdate) AS VARCHAR) || '.xlsx' AS source_file,
           l_shipdate AS loaded_at,
           c_custkey AS k, l_orderkey * 8 + l_linenumber AS row_no{_TABLES}
  )"""


def _units(x: str) -> str:
    return f"CAST(round(sum(CAST({x} AS DECIMAL(38,12))), 6) * 1000000 AS HUGEINT)"


def money_sum(x: str) -> str:
    return f"CAST(round(round(sum(CAST({x} AS DECIMAL(38,12))), 6), 2) AS DECIMAL(38,2))"


def money_avg(x: str) -> str:
    cents = f"(2 * {_units(x)} + 10000 * count({x})) // nullif(20000 * count({x}), 0)"
    return f"CAST(CAST({cents} AS DECIMAL(38,0)) / 100.0 AS DECIMAL(38,2))"


def money_one(aggregate: str) -> str:
    return f"CAST(round(CAST({aggregate} AS DECIMAL(38,6)), 2) AS DECIMAL(38,2))"


def _share() -> str:
    total = f"nullif(sum({_units('sales_amount')}) OVER (), 0)"
    hundredths = f"(20000 * {_units('sales_amount')} + {total}) // (2 * {total})"
    return f"CAST(CAST({hundredths} AS DECIMAL(38,0)) / 100.0 AS DECIMAL(38,2))"


_N, _QTY = "count(*)", "CAST(sum(quantity) AS BIGINT)"
_REV, _AVG = money_sum("sales_amount"), money_avg("sales_amount")
_AVG_PRICE = money_avg("price_per_unit")
_CUSTOMERS = "count(DISTINCT customer_name)"
_MONTH = "strftime(sale_date, '%Y-%m')"


def _view(keys: str, measures: dict[str, str], where: str = "", month: bool = False) -> str:
    picked = ", ".join([*(f"{_MONTH} AS month" if c == "month" else c for c in keys.split())])
    computed = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    condition = f"WHERE {where}" if where else ""
    return f"SELECT {picked}, {computed} FROM staging_sales {condition} GROUP BY ALL"


VIEW_SQL = {
    "kpi_summary": f"""
        SELECT coalesce({_REV}, 0) AS total_revenue, count(*) AS total_transactions,
               {_CUSTOMERS} AS unique_customers, coalesce({_QTY}, 0) AS total_units_sold,
               coalesce({_AVG}, 0) AS avg_order_value,
               count(DISTINCT source_file) AS files_processed,
               count(DISTINCT product_name) AS unique_products,
               min(sale_date) AS earliest_sale, max(sale_date) AS latest_sale,
               max(loaded_at) AS last_loaded
        FROM staging_sales""",
    "daily_sales": _view("sale_date", {
        "transaction_count": _N, "total_quantity": _QTY, "total_revenue": _REV,
        "calculated_revenue": money_sum("quantity * price_per_unit"), "avg_order_value": _AVG,
    }, "sale_date IS NOT NULL"),
    "monthly_kpis": _view("month", {
        "total_orders": _N, "total_items_sold": _QTY, "total_revenue": _REV, "average_order_value": _AVG,
    }, "sale_date IS NOT NULL"),
    "regional_performance": _view("region state", {
        "unique_customers": _CUSTOMERS, "total_orders": _N, "total_quantity": _QTY,
        "total_revenue": _REV, "avg_order_value": _AVG, "revenue_share_pct": _share(),
    }),
    "city_performance": _view("city state region", {
        "unique_customers": _CUSTOMERS, "total_orders": _N, "total_quantity": _QTY,
        "total_revenue": _REV, "avg_order_value": _AVG,
    }),
    "category_summary": _view("product_category", {
        "product_count": "count(DISTINCT product_name)", "total_orders": _N, "total_units": _QTY,
        "total_revenue": _REV, "avg_order_value": _AVG,
        "min_price": money_one("min(price_per_unit)"), "max_price": money_one("max(price_per_unit)"),
    }),
    "product_performance": _view("product_name product_category", {
        "total_orders": _N, "total_units_sold": _QTY, "total_revenue": _REV,
        "avg_price": _AVG_PRICE, "avg_order_value": _AVG, "revenue_share_pct": _share(),
    }),
    "top_customers": _view("customer_name city state region", {
        "total_orders": _N, "total_quantity": _QTY, "total_spent": _REV, "avg_order_value": _AVG,
        "first_purchase": "min(sale_date)", "last_purchase": "max(sale_date)",
    }),
    "product_region": _view("product_name product_category region", {
        "total_quantity": _QTY, "total_revenue": _REV, "avg_price": _AVG_PRICE,
    }),
    "product_city": _view("product_name product_category city state", {
        "total_quantity": _QTY, "total_revenue": _REV, "avg_price": _AVG_PRICE,
    }),
    "date_summary": _view("sale_date", {
        "order_count": _N, "total_quantity": _QTY, "total_revenue": _REV,
    }, "sale_date IS NOT NULL"),
    "date_region": _view("sale_date region", {
        "total_quantity": _QTY, "total_revenue": _REV, "order_count": _N,
    }, "sale_date IS NOT NULL"),
    "date_city": _view("sale_date city state region", {
        "total_quantity": _QTY, "total_revenue": _REV, "order_count": _N,
    }, "sale_date IS NOT NULL"),
    "heatmap_region_month": _view("region month", {
        "revenue": _REV, "total_units": _QTY,
    }, "sale_date IS NOT NULL AND region IS NOT NULL"),
    "customer_hierarchy": _view("region customer_name", {
        "total_quantity": _QTY, "total_spent": _REV, "total_orders": _N,
    }),
    "pipeline_stats": _view("source_file", {
        "records_loaded": _N, "first_loaded_at": "min(loaded_at)", "last_loaded_at": "max(loaded_at)",
        "earliest_sale_date": "min(sale_date)", "latest_sale_date": "max(sale_date)",
        "total_revenue": _REV, "unique_customers": _CUSTOMERS,
    }),
}

DASHBOARD_SQL = {
    "dash_kpis": f"""
        SELECT total_revenue, total_transactions, unique_customers, total_units_sold,
               avg_order_value, files_processed FROM ({VIEW_SQL['kpi_summary']}) LIMIT 1""",
    "dash_daily_sales": f"""
        SELECT CAST(sale_date AS VARCHAR) AS sale_date, total_revenue, transaction_count
        FROM ({VIEW_SQL['daily_sales']})""",
    "dash_regional": f"""
        SELECT region, total_revenue, total_orders, unique_customers
        FROM ({VIEW_SQL['regional_performance']})""",
    "dash_category": f"""
        SELECT product_category, total_revenue, total_units FROM ({VIEW_SQL['category_summary']})""",
    "dash_top_products": f"""
        SELECT product_name, product_category, total_revenue, total_units_sold, avg_price
        FROM ({VIEW_SQL['product_performance']})
        ORDER BY total_revenue DESC NULLS FIRST, product_name ASC NULLS LAST,
                 product_category ASC NULLS LAST LIMIT 15""",
    "dash_top_customers": f"""
        SELECT customer_name, city, state, region, total_orders, total_spent, avg_order_value
        FROM ({VIEW_SQL['top_customers']})
        ORDER BY total_spent DESC NULLS FIRST, customer_name ASC NULLS LAST, city ASC NULLS LAST,
                 state ASC NULLS LAST, region ASC NULLS LAST LIMIT 20""",
    "dash_file_statistics": f"""
        SELECT source_file, records_loaded, CAST(first_loaded_at AS VARCHAR) AS first_loaded_at,
               total_revenue FROM ({VIEW_SQL['pipeline_stats']})""",
}

_SALES_LIST = """sale_date, customer_name, city, state, region, product_category, product_name,
               quantity, price_per_unit, sales_amount"""

TABLE_SQL = {
    "staging_rows": f"SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales",
    "filtered_sales": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales
        WHERE sale_date BETWEEN DATE '1996-03-15' AND DATE '1998-02-10'
          AND region IN ('ASIA', 'EUROPE') AND product_category IN ('PROMO', 'ECONOMY')""",
    "fine_amounts": f"""
        SELECT product_category, {money_sum('sales_amount / 7.0')} AS total, {money_avg('sales_amount / 7.0')} AS average
        FROM staging_sales GROUP BY product_category""",
    "filtered_by_customer": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales
        WHERE customer_name IN ('Customer#000000007', 'Customer#000000042')""",
    "filtered_by_file": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales WHERE source_file = 'sales_1997.xlsx'""",
    "filtered_by_load_time": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales
        WHERE loaded_at BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-06-30'""",
    "clustered_by_city": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales
        WHERE city IN ('NATION_1_C1', 'NATION_8_C2', 'NATION_17_C3')""",
    "clustered_by_category": f"""
        SELECT {_SALES_LIST}, source_file, loaded_at FROM staging_sales WHERE product_category = 'PROMO'""",
}


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_ALIAS_ROWS = [(s, name) for name, spellings in HEADER_ALIASES.items() for s in spellings]
_WORDS = "array_to_string(list_sort(list_filter(string_split_regex({0}, '[^a-z0-9_]+'), lambda w: w <> '')), ' ')"

# Headers of all files, their best aliases, and what follows per file.
HEADERS = f"""
  files AS (
    SELECT {untidy.SOURCE_FILE_SQL} AS source_file, c_custkey AS k, {untidy.TURN_SQL} AS turn FROM customer
  ),
  listed AS (
    SELECT source_file, k, list_concat(
             list_transform([{", ".join("{'name': '%s', 'other': '%s'}" % p for p in untidy.COLUMN_PAIRS)}],
                            lambda c: {untidy.HEADER_SQL}),
             CASE WHEN {untidy.EXTRA_COLUMN} THEN ['Remarks'] ELSE [] END,
             CASE WHEN {untidy.SECOND_AMOUNT} THEN ['Revenue'] ELSE [] END) AS straight
    FROM files
  ),
  file_headers AS (
    SELECT source_file, k,
           CASE WHEN {untidy.REVERSED} THEN list_reverse(straight) ELSE straight END AS headers
    FROM listed
  ),
  each_header AS (
    SELECT source_file, CAST(i - 1 AS INT) AS position, headers[i] AS raw_header,
           replace(replace(lower(trim(headers[i])), ' ', '_'), '-', '_') AS norm
    FROM (SELECT source_file, headers, unnest(range(1, len(headers) + 1)) AS i FROM file_headers)
  ),
  aliases AS (
    SELECT alias, canonical, row_number() OVER () AS ord, {_WORDS.format('alias')} AS words
    FROM (VALUES {_values(_ALIAS_ROWS)}) AS v(alias, canonical)
  ),
  pairs AS (
    SELECT norm, {_WORDS.format('norm')} AS h, alias, canonical, ord, words AS a
    FROM (SELECT DISTINCT norm FROM each_header WHERE norm NOT IN (SELECT alias FROM aliases)), aliases
  ),
  lcs AS (
    SELECT norm, h, alias, canonical, ord, a, 0 AS i,
           list_transform(range(length(a) + 1), lambda x: 0) AS best
    FROM pairs
    UNION ALL
    SELECT norm, h, alias, canonical, ord, a, i + 1,
           list_concat([0], list_transform(range(1, length(a) + 1), lambda j:
             list_max(list_transform(range(1, j + 1), lambda q:
               greatest(best[q + 1], best[q] + CASE WHEN substr(h, i + 1, 1) = substr(a, q, 1) THEN 1 ELSE 0 END)))))
    FROM lcs WHERE i < length(h)
  ),
  scored AS (
    SELECT norm, alias, canonical, ord,
           200.0 * best[length(a) + 1] / (length(h) + length(a)) AS ratio,
           CAST(round_even(200.0 * best[length(a) + 1] / (length(h) + length(a)), 0) AS INT) AS score
    FROM lcs WHERE i = length(h)
  ),
  closest AS (
    SELECT norm, alias, canonical, score FROM scored
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY ratio DESC, ord) = 1
  ),
  header_map AS (
    SELECT source_file, position, raw_header,
           CASE WHEN e.canonical IS NOT NULL THEN e.canonical WHEN c.score >= 70 THEN c.canonical END AS canonical,
           coalesce(e.alias, c.alias) AS via_alias,
           CASE WHEN e.canonical IS NOT NULL THEN 100 ELSE c.score END AS score,
           CASE WHEN e.canonical IS NOT NULL THEN 'exact' WHEN c.score >= 70 THEN 'fuzzy'
                ELSE 'low_score' END AS method
    FROM each_header LEFT JOIN aliases e ON norm = e.alias LEFT JOIN closest c USING (norm)
  ),
  wanted AS (
    SELECT canonical, row_number() OVER () AS nth
    FROM (VALUES {_values([(c,) for c in CANONICAL_COLUMNS])}) AS v(canonical)
  ),
  fit AS (
    SELECT source_file, count(m.canonical) AS hits, canonical, nth
    FROM (SELECT DISTINCT source_file FROM each_header) CROSS JOIN wanted
         LEFT JOIN header_map m USING (source_file, canonical)
    GROUP BY source_file, canonical, nth
  ),
  file_plan AS (
    SELECT source_file,
           coalesce(string_agg(canonical, ', ' ORDER BY nth) FILTER (WHERE hits = 0), '') AS missing,
           coalesce(string_agg(canonical, ', ' ORDER BY nth) FILTER (WHERE hits > 1), '') AS duplicated
    FROM fit GROUP BY source_file
  )"""

# What cleaning must give back, starting from the clean values.
CLEANED = f"""
  numbered AS (
    SELECT *, replace(customer_name, '#', '_') || '.xlsx' AS file_name,
           ({untidy.UNREADABLE_DATES} OR {untidy.BAD_DATE}) AS bad_date
    FROM staging_sales
  ),
  -- A month-first file whose days could all be months reads as day-first: that format is tried earlier.
  date_mode AS (
    SELECT file_name, arg_min(NOT bad_date, row_no) AS first_is_good,
           bool_and(bad_date OR day(sale_date) <= 12) AS ambiguous
    FROM numbered GROUP BY file_name
  ),
  expected AS (
    SELECT CASE WHEN bad_date THEN NULL
                WHEN {untidy.DATE_STYLE} = {untidy.SERIAL_STYLE} AND NOT first_is_good THEN NULL
                WHEN {untidy.DATE_STYLE} = 2 AND ambiguous
                THEN make_date(year(sale_date), day(sale_date), month(sale_date))
                ELSE sale_date END AS sale_date,
           CASE WHEN {untidy.NO_CUSTOMER} THEN NULL ELSE customer_name END AS customer_name,
           city, state, region, product_category, product_name,
           CASE WHEN {untidy.BAD_QUANTITY} THEN NULL ELSE quantity END AS quantity,
           price_per_unit, {untidy.DATE_STYLE} AS date_style,
           CASE WHEN {untidy.BAD_AMOUNT} THEN NULL ELSE sales_amount END AS sales_amount,
           n.file_name AS source_file, row_no,
           (missing = '' AND duplicated = '') AS usable
    FROM numbered n JOIN date_mode d ON n.file_name = d.file_name
         JOIN file_plan p ON n.file_name = p.source_file
  ),
  report AS (
    SELECT f.source_file, CAST(len(f.headers) AS INT) AS columns_read, count(e.row_no) AS rows_read,
           count_if(e.usable AND e.sale_date IS NOT NULL AND e.customer_name IS NOT NULL
                    AND e.sales_amount IS NOT NULL) AS rows_loaded,
           any_value(missing) AS missing, any_value(duplicated) AS duplicated, any_value(f.headers) AS headers
    FROM file_headers f JOIN file_plan p ON f.source_file = p.source_file
         LEFT JOIN expected e ON e.source_file = f.source_file
    GROUP BY f.source_file, len(f.headers)
  ),
  file_report AS (
    SELECT source_file, columns_read, rows_read, CAST(rows_loaded AS BIGINT) AS rows_loaded,
           CAST(CASE WHEN missing = '' AND duplicated = '' THEN rows_read - rows_loaded ELSE 0 END AS BIGINT)
             AS rows_dropped,
           CASE WHEN rows_read = 0 THEN 'The sheet has headers only.'
                WHEN missing <> '' THEN 'No column found for ' || missing || '; the sheet is headed '
                     || array_to_string(headers, ', ')
                WHEN duplicated <> '' THEN 'Several headers map to one column: ' || duplicated
                WHEN rows_loaded = 0 THEN 'Each row lacks a date, a customer or an amount.' END AS reason
    FROM report
  )"""

INGEST_SQL = {
    "header_map": "SELECT * FROM header_map",
    "header_map_by_table": """SELECT * REPLACE (CASE WHEN method <> 'low_score' THEN via_alias END AS via_alias,
        CASE WHEN method <> 'low_score' THEN score ELSE 0 END AS score, replace(method, 'low_score', 'no_match') AS method)
        FROM header_map""",
    "file_plan": "SELECT * FROM file_plan",
    "clean_sales": f"""
        SELECT {_SALES_LIST}, source_file FROM expected
        WHERE usable AND sale_date IS NOT NULL AND customer_name IS NOT NULL AND sales_amount IS NOT NULL""",
    "clean_sales_iso": f"""
        SELECT {_SALES_LIST}, source_file FROM expected
        WHERE usable AND sale_date IS NOT NULL AND customer_name IS NOT NULL AND sales_amount IS NOT NULL
          AND date_style NOT IN (1, 2)""",
    "file_report": "SELECT * FROM file_report",
    "quarantined_rows": """
        SELECT source_file, row_no, len(headers) AS cell_count, reason
        FROM expected JOIN file_report USING (source_file) JOIN file_headers USING (source_file)
        WHERE reason IS NOT NULL""",
    "file_events": """
        SELECT source_file, event,
               CASE WHEN event <> 'detected' THEN rows_read END AS rows_read,
               CASE WHEN event <> 'detected' THEN rows_loaded END AS rows_loaded,
               CASE WHEN event = 'failure' THEN substr(reason, 1, 600)
                    WHEN event = 'corrupted' THEN substr(reason, 1, 400) END AS message,
               CASE WHEN event <> 'detected'
                    THEN CASE WHEN reason IS NULL THEN 'processed' ELSE 'failed' END END AS disposition,
               CASE WHEN event <> 'detected' THEN '20240102_030405_' || source_file END AS target_name
        FROM (SELECT *, unnest(CASE WHEN reason IS NULL THEN ['detected', 'success']
                                    ELSE ['detected', 'failure', 'corrupted'] END) AS event
              FROM file_report)""",
}

# Loaded from workbooks; the workbook a row travelled in depends on the plan.
WORKBOOK_SQL = {
    "workbook_scan": f"SELECT {_SALES_LIST} FROM staging_sales",
    **{name: f"SELECT {_SALES_LIST} FROM staging_sales"
       for name in ("folder_batch", "batch_then_stream", "two_streams", "ingest_resumed", "retried_files")},
    "overlapping_loads": f"""SELECT loads, {_SALES_LIST} FROM staging_sales,
        (VALUES ('batch in stream'), ('stream in batch'), ('batch in batch')) AS l(loads)""",
    "row_order": """
        SELECT 'v_daily_sales' AS name, count(DISTINCT sale_date) AS n_rows, 0::BIGINT AS n_out_of_order FROM staging_sales
        UNION ALL SELECT 'daily_sales', count(DISTINCT sale_date), 0 FROM staging_sales
        UNION ALL SELECT n, count(*), 0 FROM (SELECT DISTINCT region, state FROM staging_sales),
            (VALUES ('v_regional_performance'), ('regional')) AS v(n) GROUP BY n
        UNION ALL SELECT 'v_date_region', count(*), 0 FROM (SELECT DISTINCT sale_date, region FROM staging_sales WHERE sale_date IS NOT NULL)
        UNION ALL SELECT 'v_heatmap_region_month', count(*), 0
            FROM (SELECT DISTINCT region, strftime(sale_date, '%Y-%m') FROM staging_sales WHERE sale_date IS NOT NULL AND region IS NOT NULL)
        UNION ALL SELECT 'file_statistics', count(DISTINCT source_file), 0 FROM staging_sales""",
    "sql_access": """SELECT region, state, count(*) AS total_orders, (SELECT count(*) FROM staging_sales) AS all_rows,
        true AS no_row, 0::BIGINT AS unwritten_rows FROM staging_sales WHERE region = 'ASIA' GROUP BY region, state""",
    "load_defaults": """SELECT 'part-' || (year(sale_date) % 3) AS batch, count(*) AS rows_loaded, 1::BIGINT AS n_times, true AS of_now
        FROM staging_sales GROUP BY ALL""",
    "last_resort_dates": "SELECT DISTINCT year(sale_date) || '.xlsx' AS source_file, sale_date FROM staging_sales",
    "long_messages": """SELECT c_name || '.xlsx' AS source_file, event,
        substr(repeat(c_name || '; ' || c_mktsegment, 40), 1, CASE event WHEN 'failure' THEN 600 ELSE 400 END) AS message,
        '20240102_030405_' || c_name || '.xlsx' AS target_name FROM customer, (VALUES ('failure'), ('corrupted')) AS e(event)""",
    "approx_customers": f"""SELECT region, state, {_CUSTOMERS} AS unique_customers, true AS within_error
        FROM staging_sales GROUP BY ALL""",
    "log_after_compaction": """SELECT strftime(sale_date, '%Y-%m') AS sale_month, count(*) AS rows_loaded,
        CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(count(*)) OVER () AS BIGINT) AS rows_committed
        FROM staging_sales GROUP BY ALL""",
    "stream_ingest": f"SELECT {_SALES_LIST}, strftime(sale_date, '%Y-%m') AS sale_month FROM staging_sales",
}


def oracle_sql() -> dict[str, str]:
    """One self-contained statement per registered query."""
    out = {}
    for group in (VIEW_SQL, DASHBOARD_SQL, TABLE_SQL, WORKBOOK_SQL):
        out.update({name: f"WITH {SALES} {sql}" for name, sql in group.items()})
    out.update({name.replace("dash_", "refreshed_"): out[name] for name in DASHBOARD_SQL})
    for name, sql in INGEST_SQL.items():
        headers_only = name in ("header_map", "header_map_by_table", "file_plan")
        parts = HEADERS if headers_only else f"{SALES}, {HEADERS}, {CLEANED}"
        out[name] = f"WITH RECURSIVE {parts} {sql}"
    return out
