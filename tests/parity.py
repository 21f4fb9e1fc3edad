"""Compare a query with its DuckDB SQL over the same tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_bool_dtype(column):
            frame[name] = column.astype(int)
        elif pd.api.types.is_numeric_dtype(column):
            frame[name] = column.astype(float)
        else:
            frame[name] = column.map(lambda v: None if v is None or v is pd.NaT or v != v else str(v)[:10] if hasattr(v, "year") else str(v))
    return frame.sort_values(list(frame.columns), na_position="last", ignore_index=True)


def difference(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    left, right = _plain(actual), _plain(expected)
    for name in left.columns:
        a, b = left[name], right[name]
        if a.dtype.kind == "f" and b.dtype.kind == "f":
            same = (a.to_numpy() == b.to_numpy()) | (np.isnan(a.to_numpy()) & np.isnan(b.to_numpy()))
        else:
            same = ((a == b) | (a.isna() & b.isna())).to_numpy()
        if not same.all():
            at = int(np.argmin(same))
            return f"column {name}: {int((~same).sum())} rows differ, first {a.iloc[at]!r} != {b.iloc[at]!r}"
    return None
