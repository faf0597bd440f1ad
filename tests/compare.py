"""Rows of a Spark frame and of DuckDB SQL in one comparable form."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v) or math.isinf(v):
            return str(v)
        return int(v) if v == int(v) and abs(v) < 1e15 else v
    if getattr(v, "tzinfo", None):
        return v.replace(tzinfo=None)
    return v


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return con


def of_frame(df) -> tuple[list[str], list[list]]:
    names = sorted(df.columns)
    return names, sorted(([plain(r[c]) for c in names] for r in df.collect()), key=repr)


def of_sql(con, sql: str) -> tuple[list[str], list[list]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(c) for c in names]
    return names, sorted(([plain(r[i]) for i in at] for r in result.fetchall()), key=repr)
