"""Compare a Spark result with a SQL result, column by column and without order."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return _sorted(columns, result.fetchall())
