"""Shared parts of the vector operators: which vectors take part, equal vectors as one node, arrays for numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and all components present and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``rows`` as id, node and vec (doubles). Equal vectors share a node, a 64-bit hash; it is null for vectors that take
    no part, among them those of another length than most (the longer one if lengths are as frequent)."""
    typed = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    good = usable(F.col("vec"))
    lengths = typed.filter(good).groupBy(F.size("vec").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    takes_part = good & (F.size("vec") == (usual.length if usual else 0))
    positive = F.transform("vec", lambda x: x + 0.0)  # -0.0 becomes 0.0, so equal vectors hash alike
    return typed.select("id", F.when(takes_part, F.xxhash64(positive)).alias("node"), F.when(takes_part, F.col("vec")).alias("vec"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def lists(values: list[np.ndarray], type: pa.DataType) -> pa.Array:
    """A list column from arrays."""
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, type))
