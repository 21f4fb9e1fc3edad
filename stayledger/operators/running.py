"""Running totals over a sorted column, without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import reliable_checkpoint

ROWS_IN_PART = 1_000_000  # what one task sorts


def running_totals_descending(df: DataFrame, order: str, amounts: list[str]) -> DataFrame:
    """Add ``upto_<amount>``: the sum over all rows with an ``order`` value at least as high, and ``next_<amount>``: that of
    the row with the next lower one, null in the last row. ``order`` is unique.

    Range partitions are kept in the shared folder, so the totals of the partitions and the sums inside them see the
    same cuts. The only unpartitioned window works on one row per partition.
    """
    once = reliable_checkpoint(df)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = max(usual, -(-once.count() // ROWS_IN_PART))
    ranged = reliable_checkpoint(once.repartitionByRange(width, F.desc(order)).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(*[F.sum(a).alias(f"_{a}") for a in amounts], *[F.max_by(a, order).alias(f"_first_{a}") for a in amounts])
    following = Window.orderBy("_part")
    offsets = totals.select(
        "_part",
        *[F.coalesce(F.sum(f"_{a}").over(before), F.lit(0)).alias(f"_before_{a}") for a in amounts],
        *[F.lead(f"_first_{a}").over(following).alias(f"_after_{a}") for a in amounts],  # parts without rows are not among them
    )
    inside = Window.partitionBy("_part").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = Window.partitionBy("_part").orderBy(F.desc(order))
    local = ranged.withColumns({f"upto_{a}": F.sum(a).over(inside) for a in amounts} | {f"next_{a}": F.lead(a).over(ordered) for a in amounts})
    joined = local.join(F.broadcast(offsets), "_part")
    sums = {f"upto_{a}": F.col(f"upto_{a}") + F.col(f"_before_{a}") for a in amounts}
    nexts = {f"next_{a}": F.coalesce(f"next_{a}", f"_after_{a}") for a in amounts}
    return joined.withColumns(sums | nexts).drop("_part", *[f"_{tag}_{a}" for tag in ("before", "after") for a in amounts])
