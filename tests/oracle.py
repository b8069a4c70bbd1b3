"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare.

Comparison: same column names (sorted), same row count, and the same multiset
of rows after normalising values (floats rounded, timestamps as text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from cdcmart.plans.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)


def compare(df, con, sql):
    """Return (ok, message)."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return False, f"columns differ: spark {sc} vs oracle {dc}"
    if len(sr) != len(dr):
        return False, f"row counts differ: spark {len(sr)} vs oracle {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return False, f"first differing row: spark {a} vs oracle {b}"
    return True, f"{len(sr)} rows match"
