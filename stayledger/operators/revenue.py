"""Revenue and rate aggregates, and their top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import buckets, calendar
from ..functions.measures import mean_money, money, rows
from .trends import by_bucket, by_category, by_month


def _revenue_measures():
    return money("revenue").alias("total_revenue"), rows().alias("booking_count"), F.round(mean_money("adr"), 6).alias("avg_adr")


def revenue_kpis(df: DataFrame) -> DataFrame:
    """Total revenue, mean rate, revenue of cancelled bookings, and RevPAR taken as mean rate x kept share."""
    return df.agg(
        money("revenue").alias("total_revenue"),
        F.round(mean_money("adr"), 6).alias("avg_daily_rate"),
        F.round(mean_money("adr") * (1 - F.avg("is_canceled")), 6).alias("revpar"),
        F.coalesce(money(F.when(F.col("is_canceled") == 1, F.col("revenue"))), F.lit(0.0)).alias("potential_revenue_lost"),
    )


def monthly_revenue(df: DataFrame) -> DataFrame:
    return by_month(df, money("revenue").alias("total_revenue"), rows().alias("booking_count"))


def monthly_adr(df: DataFrame) -> DataFrame:
    return by_month(df, F.round(mean_money("adr"), 6).alias("avg_adr"))


def revenue_by(df: DataFrame, name: str) -> DataFrame:
    """Revenue, bookings and mean rate per value, highest revenue first."""
    return by_category(df, name, *_revenue_measures()).orderBy(F.desc("total_revenue"), name)


def revenue_by_season(df: DataFrame) -> DataFrame:
    seasons = by_category(df, "season", *_revenue_measures())
    return seasons.withColumn("season_order", calendar.season_order("season")).orderBy("season_order")


def revenue_by_stay(df: DataFrame) -> DataFrame:
    """Revenue and mean rate per stay bucket; an empty bucket has no revenue and no mean."""
    total, _, rate = _revenue_measures()
    stays = by_bucket(df, "total_stay_nights", buckets.STAY, "stay_duration_bucket", total, rate)
    return stays.withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0))).orderBy("bucket_order")


def top_markets(df: DataFrame, n: int = 3) -> DataFrame:
    return revenue_by(df, "market_segment").limit(n)


def seasons_by_revenue(df: DataFrame) -> DataFrame:
    return by_category(df, "season", *_revenue_measures()).drop("booking_count").orderBy(F.desc("total_revenue"), "season")


def top_rooms(df: DataFrame, n: int = 3) -> DataFrame:
    """Room types with the highest mean rate, compared before rounding."""
    rooms = by_category(df, "reserved_room_type", *_revenue_measures(), mean_money("adr").alias("exact_adr"))
    return rooms.orderBy(F.desc("exact_adr"), "reserved_room_type").limit(n).drop("exact_adr")


def top_stays(df: DataFrame, n: int = 3) -> DataFrame:
    return revenue_by_stay(df).orderBy(F.desc("total_revenue"), "bucket_order").limit(n)
