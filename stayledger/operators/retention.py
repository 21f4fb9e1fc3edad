"""Repeat guests, value segments and operating figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import exact_percent, mean_money, mean_where, percent, rows, rows_where, total_value
from ..functions.risk import value_segment
from .quantiles import exact_quantile
from .trends import by_category


def with_value_segment(df: DataFrame) -> DataFrame:
    """Add the value of a booking and whether it reaches the 75th percentile of all bookings in ``df``."""
    valued = df.withColumn("total_value", total_value())
    threshold = exact_quantile(valued, "total_value", 0.75)
    return valued.withColumn("value_segment", value_segment("total_value", threshold))


def retention_kpis(df: DataFrame) -> DataFrame:
    """Repeat rates and the spending of repeat and new guests."""
    segmented = with_value_segment(df)
    high = F.col("value_segment") == "High Value"
    repeat, new = F.col("is_repeated_guest") == 1, F.col("is_repeated_guest") == 0
    figures = segmented.agg(
        percent("is_repeated_guest").alias("repeat_rate"),
        (rows_where(high & repeat) * 100.0).alias("_high_repeat"),
        rows_where(high).alias("_high"),
        mean_money(F.when(repeat, F.col("total_value"))).alias("_spend_repeat"),
        mean_money(F.when(new, F.col("total_value"))).alias("_spend_new"),
        mean_where(repeat, "total_of_special_requests").alias("_requests_repeat"),
        mean_where(new, "total_of_special_requests").alias("_requests_new"),
    )
    more = F.when(F.col("_spend_new") > 0, (F.col("_spend_repeat") / F.col("_spend_new") - 1) * 100).otherwise(0.0)
    return figures.select(
        "repeat_rate",
        F.coalesce(F.round(F.try_divide("_high_repeat", "_high"), 6), F.lit(0.0)).alias("high_value_repeat_rate"),
        F.round("_spend_repeat", 6).alias("avg_spend_repeat"),
        F.round("_spend_new", 6).alias("avg_spend_new"),
        F.round(more, 6).alias("spend_diff_pct"),
        F.round("_requests_repeat", 6).alias("avg_requests_repeat"),
        F.round("_requests_new", 6).alias("avg_requests_new"),
    )


def retention_by(df: DataFrame, name: str) -> DataFrame:
    """Repeat rate and bookings per value, highest rate first."""
    figures = percent("is_repeated_guest").alias("repeat_rate"), rows().alias("booking_count")
    rates = by_category(df, name, *figures, exact_percent("is_repeated_guest").alias("exact_rate"))
    return rates.orderBy(F.desc("exact_rate"), name).drop("exact_rate")


def operational_kpis(df: DataFrame) -> DataFrame:
    return df.agg(
        F.round(F.avg("lead_time"), 6).alias("avg_lead_time"),
        F.round(F.avg("total_stay_nights"), 6).alias("avg_stay_length"),
        percent(F.col("room_changed").cast("int")).alias("room_change_rate"),
    )
