"""Compare a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples; floats by their repr, nulls as None."""
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return repr(float(v) + 0.0)
        return str(v)

    rows = [tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple("" if v is None else v for v in r))


def differences(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame, limit: int = 5):
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return [("columns", sorted(spark_frame.columns), sorted(oracle_frame.columns))]
    left, right = canonical(spark_frame), canonical(oracle_frame)
    if left == right:
        return []
    found = [("rows", len(left), len(right))]
    lset, rset = set(left), set(right)
    found += [("spark only", r) for r in sorted(lset - rset, key=str)[:limit]]
    found += [("sql only", r) for r in sorted(rset - lset, key=str)[:limit]]
    return found
