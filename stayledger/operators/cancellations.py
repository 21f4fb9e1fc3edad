"""Cancellation rates and comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import buckets
from ..functions.measures import exact_percent, mean_where, percent, rows
from .trends import by_bucket, by_category, by_month


def _rate_and_count():
    return percent("is_canceled").alias("cancellation_rate"), rows().alias("count")


def cancellation_kpis(df: DataFrame) -> DataFrame:
    cancelled = F.coalesce(F.sum("is_canceled"), F.lit(0))
    return df.agg(
        percent("is_canceled").alias("cancellation_rate"),
        rows().alias("total_bookings"),
        cancelled.alias("cancelled_bookings"),
        (rows() - cancelled).alias("confirmed_bookings"),
    )


def cancel_by_lead_time(df: DataFrame) -> DataFrame:
    return _exact_by_lead_time(df).drop("exact_rate").orderBy("bucket_order")


def _exact_by_lead_time(df: DataFrame) -> DataFrame:
    exact = exact_percent("is_canceled").alias("exact_rate")
    rates = by_bucket(df, "lead_time", buckets.LEAD_TIME, "lead_time_bucket", *_rate_and_count(), exact)
    return rates.withColumn("count", F.coalesce("count", F.lit(0)))


def cancel_by(df: DataFrame, name: str) -> DataFrame:
    """Cancellation rate and bookings per value, highest rate first."""
    rates = by_category(df, name, *_rate_and_count(), exact_percent("is_canceled").alias("exact_rate"))
    return rates.orderBy(F.desc("exact_rate"), name).drop("exact_rate")


def cancel_trend(df: DataFrame) -> DataFrame:
    return by_month(df, *_rate_and_count())


def mean_by_status(df: DataFrame, value: str) -> DataFrame:
    """Mean of a value for cancelled and kept bookings, in one pass."""
    means = df.agg(
        mean_where(F.col("is_canceled") == 1, value).alias("canceled"),
        mean_where(F.col("is_canceled") == 0, value).alias("kept"),
    )
    lines = F.array(
        F.struct(F.lit("Canceled").alias("booking_status"), F.round("canceled", 6).alias("average")),
        F.struct(F.lit("Not Canceled").alias("booking_status"), F.round("kept", 6).alias("average")),
    )
    return means.select(F.inline(lines))


def worst_lead_bucket(df: DataFrame) -> DataFrame:
    """Lead-time bucket with the highest cancellation rate."""
    return _exact_by_lead_time(df).orderBy(F.desc_nulls_last("exact_rate"), "bucket_order").limit(1).drop("exact_rate")


def worst(df: DataFrame, name: str) -> DataFrame:
    """Value with the highest cancellation rate, compared before rounding."""
    return cancel_by(df, name).limit(1)


def crosstab(df: DataFrame, dimensions: list[str], flag: str) -> DataFrame:
    """Bookings per category and flag for several categories in one pass.

    Each row is counted once per category inside its task; only (category, value, flag) totals are shuffled.
    """
    sets = [[name, flag] for name in dimensions]
    counts = df.groupingSets([[F.col(c) for c in s] for s in sets], *dimensions, flag).agg(
        rows().alias("count"), *[F.grouping(name).alias(f"_{name}") for name in dimensions]
    )
    dimension, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in dimensions:
        dimension = F.when(F.col(f"_{name}") == 0, name).otherwise(dimension)
        value = F.when(F.col(f"_{name}") == 0, F.col(name).cast("string")).otherwise(value)
    lines = counts.select(dimension.alias("dimension"), value.alias("value"), F.col(flag).alias("flag"), "count")
    return lines.filter(F.col("value").isNotNull())


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column with their share in percent, in one pass."""
    missing = df.agg(rows().alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    lines = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    return missing.select("_rows", F.inline(lines)).select(
        "column_name",
        "null_count",
        F.round(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), 6).alias("null_pct"),
    )
