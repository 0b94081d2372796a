"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio"):
        return repr(round(float(value), 9))
    return str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(canonical(r[i]) for i in order) for r in data)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want = rows([c[0] for c in res.description], res.fetchall())
    return got, want
