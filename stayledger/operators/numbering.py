"""Dense numbers 1..n over a sorted order, without sorting everything in one task.

The rows are range-partitioned and sorted, each row gets its position inside its partition, and the written result
is numbered by adding the row counts of the earlier partitions. The only single-task step works on one row per
partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position in the partition below


def with_sequence(df: DataFrame, order: list[str], name: str, width: int | None = None) -> DataFrame:
    """Add a number that grows along ``order``, nulls last; it has gaps between partitions until :func:`dense_number`.

    The scan position of a row is the last sort key. It makes the order total, so a recomputed task yields the same
    numbers, and it lets equal rows be spread over several partitions. Without a ``width``, adaptive execution merges
    small partitions.
    """
    tie = "_scan_position"
    keys = [F.col(key).asc_nulls_last() for key in order]
    tagged = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(*([width] if width else []), *keys, tie)
    return ranged.sortWithinPartitions(*keys, tie).drop(tie).withColumn(name, F.monotonically_increasing_id())


def sequence_offsets(written: DataFrame, name: str) -> DataFrame:
    """Rows before each partition, from rows already written with their sequence: one row per partition."""
    part = F.shiftright(name, _POSITION_BITS).alias("_part")
    counts = written.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))


def dense_number(written: DataFrame, offsets: DataFrame, sequence: str, name: str) -> DataFrame:
    """Replace the written sequence by numbers 1..n. ``offsets`` has one row per partition, hence the broadcast."""
    part = F.shiftright(sequence, _POSITION_BITS)
    position = F.col(sequence).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    others = [column for column in written.columns if column != sequence]
    return (
        written.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_before") + position + 1).alias(name), *others)
    )


def number_rows(df: DataFrame, order: list[str], name: str, folder: str) -> DataFrame:
    """Number ``df`` 1..n along ``order``. The rows are written to ``folder`` between the two passes."""
    df.transform(with_sequence, order, "_sequence").write.mode("overwrite").parquet(folder)
    written = df.sparkSession.read.parquet(folder)
    return dense_number(written, sequence_offsets(written, "_sequence"), "_sequence", name)
