"""Canonical columns, Spark schemas and the header alias corpus."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten columns every workbook must provide, in table order.
CANONICAL_COLUMNS = (
    "sale_date",
    "customer_name",
    "city",
    "state",
    "region",
    "product_category",
    "product_name",
    "quantity",
    "price_per_unit",
    "sales_amount",
)

# Accepted header spellings per column. The order matters, since
# the first of several equally good spellings wins.
HEADER_ALIASES = {
    "sale_date": (
        "sale_date", "saledate", "sale date", "date", "order_date",
        "transaction_date", "sale_dt", "date_of_sale",
    ),
    "customer_name": (
        "customer_name", "customer name", "customername", "client",
        "client_name", "buyer", "customer", "cust_name",
    ),
    "city": ("city", "town", "locality", "city_name"),
    "state": ("state", "province", "state_name", "st"),
    "region": ("region", "area", "zone", "territory"),
    "product_category": (
        "product_category", "category", "product category",
        "productcategory", "cat", "prod_category",
    ),
    "product_name": (
        "product_name", "product", "product name", "item",
        "item_name", "productname", "prod_name", "product_desc",
    ),
    "quantity": (
        "quantity", "qty", "units", "count", "no_of_units",
        "amount_sold", "num_units", "unit_count",
    ),
    "price_per_unit": (
        "price_per_unit", "unit_price", "price", "rate",
        "price per unit", "unitprice", "cost", "selling_price",
    ),
    "sales_amount": (
        "sales_amount", "total", "total_amount", "revenue",
        "sales amount", "total_sales", "amount", "sale_value",
        "order_value", "net_sales",
    ),
}

TEXT_COLUMNS = (
    "customer_name", "city", "state", "region", "product_category", "product_name",
)
MONEY_COLUMNS = ("price_per_unit", "sales_amount")
# A row without one of these is dropped (fixed values, as are the two lists above).
CRITICAL_COLUMNS = ("sale_date", "customer_name", "sales_amount")

SALES_FIELDS = [
    T.StructField("sale_date", T.DateType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price_per_unit", T.DoubleType()),
    T.StructField("sales_amount", T.DoubleType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
]
SALES_COLUMNS = tuple(f.name for f in SALES_FIELDS)

# Partition columns of the stored table; strings, so that no value is re-typed
# by partition inference.
PARTITION_FIELDS = [
    T.StructField("batch_id", T.StringType()),
    T.StructField("sale_month", T.StringType()),
]
# As stored, a row also keeps the path of its file, which tells apart files of one name.
STORED_SCHEMA = T.StructType([*SALES_FIELDS, T.StructField("path", T.StringType())])
STAGING_SCHEMA = T.StructType([*STORED_SCHEMA.fields, *PARTITION_FIELDS])

# A file is told apart by its path; its name is only what people see of it.
RAW_FILES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("headers", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])
RAW_ROWS_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("row_no", T.LongType(), False),
    T.StructField("cells", T.ArrayType(T.StringType())),
])

# What the workbook scan emits: one 'file' record per workbook (cells = headers, with the
# number of its data rows, the seconds it took, and whether an error is the storage's) and one 'row' record per data row.
LANDING_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
    T.StructField("storage", T.BooleanType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("kind", T.StringType()),
])

# Workbooks to be loaded: where they are, and when they were last written.
FILES_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
])

BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

INGEST_LOG_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("modified_at", T.TimestampType()),
    T.StructField("event", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("columns_read", T.IntegerType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("rows_dropped", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("message", T.StringType()),
    T.StructField("disposition", T.StringType()),
    T.StructField("target_name", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("stage", T.StringType()),
])

# One row per batch whose rows are complete; only these are seen by readers. The number is that of its commit.
COMMITS_SCHEMA = T.StructType([
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("number", T.LongType()),
])

# Files that are done with, those a load has claimed (with the number of this try), and those put off.
LOADED_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("modified_at", T.TimestampType())])
CLAIMED_SCHEMA = T.StructType([*LOADED_SCHEMA.fields, T.StructField("attempt", T.IntegerType())])
RETRIES_SCHEMA = T.StructType([
    *LOADED_SCHEMA.fields,
    T.StructField("attempt", T.IntegerType()),
    T.StructField("due_at", T.TimestampType()),
    T.StructField("reason", T.StringType()),
])

QUARANTINE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("reason", T.StringType()),
    T.StructField("batch_id", T.StringType()),
])
