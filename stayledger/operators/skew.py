"""A left join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import sent_if_small

HOT_SHARE = 1000  # a key is hot when it holds more than 1/1000 of all rows, so there are fewer than 1000 hot keys


def left_join_on_counted_key(rows: DataFrame, members: DataFrame, key: str, size: str, value: str, row_id: str = "booking_id") -> DataFrame:
    """Add ``value`` of the member with the same ``key`` to every row.

    ``members`` has one row per key and the number of rows that carry it in ``size``. Keys above 1/1000 of all rows
    are at most 999 and are broadcast. The rest is sent along while its files are small, otherwise joined in the ordinary way, where no key can dominate a task; rows
    already answered get a key made of their ``row_id``, which matches nothing and spreads them, instead of travelling
    to one task together.
    """
    hot_value, spread = f"_hot_{value}", "_join_key"
    total = members.agg(F.sum(size).alias("total")).scalar()
    hot = members.filter(F.col(size) * HOT_SHARE > total).select(key, F.col(value).alias(hot_value), F.lit(True).alias("_is_hot"))
    cold = sent_if_small(members).filter(F.col(size) * HOT_SHARE <= total).select(F.col(key).alias(spread), F.col(value).alias("_cold"))
    marked = rows.join(F.broadcast(hot), key, "left")
    nowhere = F.concat(F.lit("\u0000"), F.col(row_id).cast("string"))
    keyed = marked.withColumn(spread, F.when(F.col("_is_hot"), nowhere).otherwise(F.col(key).cast("string")))
    joined = keyed.join(cold, spread, "left")
    answer = F.when(F.col("_is_hot"), F.col(hot_value)).otherwise(F.col("_cold"))
    return joined.withColumn(value, answer).drop(spread, hot_value, "_is_hot", "_cold")
