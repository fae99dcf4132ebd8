"""Local stand-in for the driver's correctness gate: run a registered Spark
query and its DuckDB oracle on the same parquet tables and compare column
names, row counts and order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float | np.floating):
        if math.isnan(v):
            return None
        x = round(float(v), 6)
        return 0.0 if x == 0 else x
    if isinstance(v, bool | np.bool_):
        return bool(v)
    if isinstance(v, int | np.integer):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp | dt.datetime):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, np.ndarray | list | tuple):
        return tuple(_norm(x) for x in v)
    if v is pd.NaT:
        return None
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=repr)


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir).toPandas()
    con = con or duck(sf_dir)
    odf = con.execute(sql).df()
    if sorted(sdf.columns) != sorted(odf.columns):
        return False, f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return False, f"row count spark={len(sdf)} oracle={len(odf)}"
    a, b = rows(sdf), rows(odf)
    if a != b:
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diffs}"
    return True, f"{len(sdf)} rows"
