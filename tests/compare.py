"""Compare a Spark result with DuckDB's answer, row by row."""

from __future__ import annotations

from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _sorted(df.columns, [tuple(row) for row in df.collect()])


def duckdb_rows(con, sql):
    cursor = con.execute(sql)
    return _sorted([d[0] for d in cursor.description], cursor.fetchall())
