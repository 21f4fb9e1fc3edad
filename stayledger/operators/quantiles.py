"""Exact interpolated quantiles and most frequent values without gathering a column in one task.

The sketch behind ``percentile_approx`` brackets the wanted ranks, the bracket is narrowed until it holds few distinct
values, and only the counts of those are ranked. Each step is a filtered partial aggregation; only scalars come back.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

MAX_RANKED_VALUES = 100_000
_SKETCH_ACCURACY = 10_000


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    """Linearly interpolated quantile of the non-null values; ``None`` when there are none."""
    return exact_quantiles(df, [column], q)[column]


def exact_quantiles(df: DataFrame, columns: list[str], q: float) -> dict[str, float | None]:
    """The same quantile of several columns. Columns with few distinct values, the usual case, share two passes."""
    if not columns:
        return {}
    data = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    margin = 2.0 / _SKETCH_ACCURACY
    probes = [max(0.0, q - margin), min(1.0, q + margin)]
    stats = data.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.min(c).alias("least"),
                F.max(c).alias("most"),
                F.percentile_approx(c, probes, _SKETCH_ACCURACY).alias("near"),
                F.approx_count_distinct(c).alias("distinct"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    known = [c for c in columns if stats[c]["n"]]
    positions = {c: q * (stats[c]["n"] - 1) for c in known}
    few = [c for c in known if stats[c]["distinct"] <= MAX_RANKED_VALUES // 2]
    found = _ranked_together(data, few, positions) if few else {}
    for c in set(known) - set(few):
        values = data.select(F.col(c).alias("value")).filter(F.col("value").isNotNull())
        found[c] = _bracketed(values, stats[c], math.floor(positions[c]), math.ceil(positions[c]))
    result: dict[str, float | None] = dict.fromkeys(columns)
    for c, (low, high) in found.items():
        result[c] = low + (high - low) * (positions[c] - math.floor(positions[c]))
    return result


def _at_ranks(upto: str, low_rank: int, high_rank: int, condition=None):
    """Smallest values whose running count passes two 0-based ranks."""
    chosen = F.col("value") if condition is None else F.when(condition, F.col("value"))
    return [F.min(F.when(F.col(upto) > rank, chosen)) for rank in (low_rank, high_rank)]


def _ranked_together(data: DataFrame, columns: list[str], positions: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Rank the value counts of several columns; a window partition holds the distinct values of one column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    counts = data.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("_upto", F.sum("rows").over(order))
    wanted = []
    for c in columns:
        bounds = _at_ranks("_upto", math.floor(positions[c]), math.ceil(positions[c]), F.col("column") == c)
        wanted.append(F.array(*bounds).alias(c))
    row = ranked.agg(*wanted).first()
    return {c: tuple(row[c]) for c in columns}


def _bracketed(values: DataFrame, stats, low_rank: int, high_rank: int) -> tuple[float, float]:
    """Values at two 0-based ranks of a column with many distinct values."""
    least, most = stats["least"], stats["most"]
    low, high = stats["near"]
    while True:
        below = 0
        if (low, high) != (least, most):
            place = values.agg(F.count_if(F.col("value") < low).alias("below"), F.count_if(F.col("value") <= high).alias("upto")).first()
            below = place["below"]
            if below > low_rank or place["upto"] <= high_rank:
                low, high = least, most  # the sketch missed the rank: start again from the full range
                continue
        inside = values.filter(F.col("value").between(low, high))
        counts = inside.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).persist()
        try:
            if counts.count() <= MAX_RANKED_VALUES:
                order = Window.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
                ranked = counts.withColumn("_upto", F.sum("rows").over(order) + F.lit(below))
                return tuple(ranked.agg(*_at_ranks("_upto", low_rank, high_rank)).first())
        finally:
            counts.unpersist()
        low, high = _narrow(inside, low, high, below, low_rank, high_rank)


def _narrow(inside: DataFrame, low: float, high: float, below: int, low_rank: int, high_rank: int) -> tuple[float, float]:
    """Cut the bracket to the histogram bins that hold both ranks. The histogram has a fixed number of bins."""
    bins = 4096
    width = (high - low) / bins
    slot = F.least(F.floor((F.col("value") - low) / width), F.lit(bins - 1))
    histogram = inside.groupBy(slot.alias("slot")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    upto = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = histogram.withColumn("_upto", F.sum("rows").over(upto) + F.lit(below))
    found = ranked.agg(
        F.min(F.when(F.col("_upto") > low_rank, F.col("least"))).alias("low"),
        F.min_by("most", F.when(F.col("_upto") > high_rank, F.col("_upto"))).alias("high"),
    ).first()
    return found["low"], found["high"]


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent non-null value per column, the smallest on a tie: (column_name, value).

    One row per column and distinct value is shuffled, after counting inside each task.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("column_name", "value").count()
    return counts.groupBy("column_name").agg(F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value"))
