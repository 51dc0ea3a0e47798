"""Run a query in Spark and its SQL in DuckDB, and compare names, types and values."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN",
}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _sorted_rows(rows, order):
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    expected = con.execute(sql)
    duck_names = [d[0] for d in expected.description]
    duck_types = [str(d[1]) for d in expected.description]
    duck_rows = expected.fetchall()
    names = spark_df.columns
    found = []
    if sorted(names) != sorted(duck_names):
        return [f"columns {sorted(names)} vs {sorted(duck_names)}"]
    kinds = dict(zip(names, [t for _, t in spark_df.dtypes]))
    duck_kinds = dict(zip(duck_names, duck_types))
    for name in names:
        if SPARK_TO_DUCK.get(kinds[name], kinds[name]) != duck_kinds[name]:
            found.append(f"type of {name}: {kinds[name]} vs {duck_kinds[name]}")
    ordered = sorted(names)
    ours = _sorted_rows(spark_df.collect(), [names.index(n) for n in ordered])
    theirs = _sorted_rows(duck_rows, [duck_names.index(n) for n in ordered])
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows vs {len(theirs)}")
    if ours != theirs:
        a, b = set(map(str, ours)), set(map(str, theirs))
        found.append(f"only spark: {sorted(a - b)[:3]}; only sql: {sorted(b - a)[:3]}")
    return found
