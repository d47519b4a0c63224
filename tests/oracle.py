"""Compare a query with its SQL in DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import math
import os
from pathlib import Path

import duckdb

DATA = os.environ.get("LEXQUARRY_TESTDATA", "/root/testdata")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        glob = str(p) if p.is_file() else f"{p}/*.parquet"
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{glob}')")
    return con


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(columns, data) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, name: str, query, sql: str, sf_dir: str) -> tuple[list, list]:
    """The sorted rows of both sides, columns in the order of their names."""
    df = query(spark, sf_dir)
    ours = rows(df.columns, df.collect())
    got = duck(sf_dir).sql(sql)
    assert sorted(df.columns) == sorted(got.columns), (name, df.columns, got.columns)
    return ours, rows(got.columns, got.fetchall())
