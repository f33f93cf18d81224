"""Run a registered query in Spark and its SQL in DuckDB, and compare rows regardless of order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _cell(value):
    if isinstance(value, float):
        return ("nan",) if math.isnan(value) else value + 0.0
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def difference(spark_df, db, sql: str) -> str | None:
    """None if equal, else a short account of the first difference."""
    got_columns, got = _normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = db.execute(sql)
    want_columns, want = _normal([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{str(g)[:300]} vs {str(w)[:300]}"
    return None
