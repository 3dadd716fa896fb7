"""Query results against the same question in SQL."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value) if value % 1 else int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def check(spark_df, con, sql: str) -> int:
    """Row count when both agree; fails with the first difference otherwise."""
    got_columns, got = table(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want_columns, want = table([c[0] for c in cursor.description], cursor.fetchall())
    assert got_columns == want_columns, f"columns {got_columns} != {want_columns}"
    assert len(got) == len(want), f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{mine} != {theirs}"
    return len(got)
