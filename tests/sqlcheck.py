"""Holds a query against its SQL text in DuckDB."""

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, float | decimal.Decimal):
        return round(float(x), 6)
    if isinstance(x, dt.datetime | dt.date):
        return str(x)[:19].removesuffix(" 00:00:00")
    return x


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


def assert_equal(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got, want = table(df.columns, df.collect()), table(names, result.fetchall())
    assert len(got) == len(want)
    assert got == want, next((a, b) for a, b in zip(got, want, strict=True) if a != b)
