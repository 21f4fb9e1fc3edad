"""Tables written on the way, so that later passes read files instead of repeating work, and a lost executor costs no
recomputation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the folder all executors share and read it back."""
    folder = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
