"""Booking counts by time, season, bucket and channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import buckets, calendar
from ..functions.measures import rows


def by_month(df: DataFrame, *measures: Column) -> DataFrame:
    """Aggregates per year and month in calendar order, with the labels charts need."""
    grouped = df.groupBy("year", "month").agg(*measures)
    labelled = grouped.select(
        "year",
        "month",
        calendar.month_number("month").alias("month_num"),
        calendar.year_month("year", "month").alias("year_month"),
        *[c for c in grouped.columns if c not in ("year", "month")],
    )
    return labelled.orderBy("year", "month_num")


def by_bucket(df: DataFrame, value: str, groups: buckets.Buckets, name: str, *measures: Column) -> DataFrame:
    """Aggregates per bucket. Every bucket is present; bookings outside all buckets are left out."""
    label = groups.label(value)
    grouped = df.groupBy(label.alias(name)).agg(*measures).filter(F.col(name).isNotNull())
    return groups.with_all_labels(grouped, name)


def by_category(df: DataFrame, name: str, *measures: Column) -> DataFrame:
    """Aggregates per value; a missing value is not a group."""
    return df.filter(F.col(name).isNotNull()).groupBy(name).agg(*measures)


def monthly_bookings(df: DataFrame) -> DataFrame:
    return by_month(df, rows().alias("bookings"))


def seasonal_bookings(df: DataFrame) -> DataFrame:
    counts = by_category(df, "season", rows().alias("bookings"))
    return counts.withColumn("season_order", calendar.season_order("season")).orderBy("season_order")


def bucket_distribution(df: DataFrame, value: str, groups: buckets.Buckets, name: str) -> DataFrame:
    counts = by_bucket(df, value, groups, name, rows().alias("count"))
    return counts.withColumn("count", F.coalesce("count", F.lit(0))).orderBy("bucket_order")


def lead_time_distribution(df: DataFrame) -> DataFrame:
    return bucket_distribution(df, "lead_time", buckets.LEAD_TIME, "bucket")


def stay_distribution(df: DataFrame) -> DataFrame:
    return bucket_distribution(df, "total_stay_nights", buckets.STAY, "bucket")


def lead_bucket_form(df: DataFrame) -> DataFrame:
    """Bookings per lead-time bucket by the rule of the scoring form, where 0 days belong to the first bucket."""
    label = buckets.LEAD_TIME.label_from_zero("lead_time").alias("lead_time_bucket")
    return df.groupBy(label).agg(rows().alias("count")).filter("lead_time_bucket IS NOT NULL")


def distribution(df: DataFrame, name: str) -> DataFrame:
    """Bookings per value, most frequent first."""
    return by_category(df, name, rows().alias("count")).orderBy(F.desc("count"), name)


def busiest_months(df: DataFrame, n: int = 3) -> DataFrame:
    """The n busiest and n quietest month names over all years."""
    counts = by_category(df, "month", rows().alias("count"))
    busiest = counts.orderBy(F.desc("count"), "month").limit(n).select(F.lit("busiest").alias("kind"), "month", "count")
    quietest = counts.orderBy("count", "month").limit(n).select(F.lit("quietest").alias("kind"), "month", "count")
    return busiest.unionByName(quietest)
