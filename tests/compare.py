"""Order-insensitive comparison of Spark and DuckDB results."""

import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    return f"{value:f}" if isinstance(value, decimal.Decimal) else str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    given = [d[0] for d in cursor.description]
    names = sorted(given)
    at = [given.index(n) for n in names]
    return names, sorted(tuple(_plain(r[i]) for i in at) for r in cursor.fetchall())
