"""Fingerprints that identify rows by their content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fingerprint(*columns: Column) -> list[Column]:
    """Two 64-bit hashes, taken in opposite order, so that both differ in what they start from."""
    marked = [F.coalesce(F.xxhash64(c), F.lit(0)) for c in columns]
    return [F.xxhash64(*columns, *[c.isNull() for c in columns]), F.xxhash64(F.lit(1), *marked[::-1], *columns[::-1])]
