"""Monthly demand series: rollups, complete month grids and filled gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar
from ..functions.measures import mean_money, money, rows


def monthly_demand(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Bookings, revenue and mean daily rate per year, month and hotel (and ``extra`` columns), cancelled ones included."""
    grouped = df.groupBy("year", "month", "hotel_name", *extra).agg(
        rows().alias("booking_count"),
        money(F.col("adr") * F.col("total_stay_nights")).alias("total_revenue"),
        mean_money("adr").alias("avg_daily_rate"),
    )
    return grouped.orderBy("year", calendar.month_number("month"), "hotel_name", *extra)


def total_demand(demand: DataFrame) -> DataFrame:
    """All hotels per month. ``avg_daily_rate`` is the plain mean of the hotel means; the weighted mean stands beside it."""
    dated = demand.withColumn("date", calendar.month_start("year", "month"))
    weighted = F.sum(F.col("avg_daily_rate") * F.col("booking_count")) / F.sum("booking_count")
    return dated.groupBy("date").agg(
        F.sum("booking_count").alias("booking_count"),
        F.sum("total_revenue").alias("total_revenue"),
        F.avg("avg_daily_rate").alias("avg_daily_rate"),
        weighted.alias("weighted_daily_rate"),
    )


def monthly_series(df: DataFrame, parts: tuple[str, ...] = (), value: Column | None = None) -> DataFrame:
    """One value per series and month: (series_key, month_start, value). Without ``parts`` there is one series, ``all``.

    Bookings are counted per year, month and series in each task before anything is shuffled, so a series that holds
    most bookings costs no more than another.
    """
    key = F.concat_ws(" | ", *[F.coalesce(F.col(p), F.lit("nan")) for p in parts]) if parts else F.lit("all")
    grouped = df.groupBy("year", "month", *parts).agg((rows() if value is None else value).alias("value"))
    return grouped.select(key.alias("series_key"), calendar.month_start("year", "month").alias("month_start"), "value")


def _per_series() -> Window:
    return Window.partitionBy("series_key").orderBy("month_start")


def month_grid(series: DataFrame) -> DataFrame:
    """Every month from the first to the last of each series; a month without bookings has a null value.

    Each observed month expands to the months before the next observed one, so no join with a calendar is needed.
    A series has at most one row per calendar month by then.
    """
    following = F.lead("month_start").over(_per_series())
    until = F.coalesce(F.add_months(following, -1), F.col("month_start"))
    spans = series.select("series_key", F.col("month_start").alias("_seen"), "value", until.alias("_until"))
    months = F.sequence("_seen", "_until", F.expr("INTERVAL 1 MONTH"))
    expanded = spans.select("series_key", "_seen", "value", F.explode(months).alias("month_start"))
    return expanded.select(
        "series_key", "month_start", F.when(F.col("month_start") == F.col("_seen"), F.col("value")).alias("value")
    )


def forward_fill(grid: DataFrame) -> DataFrame:
    """Replace a missing value by the last known one of its series."""
    so_far = _per_series().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return grid.withColumn("value", F.last("value", ignorenulls=True).over(so_far))


def complete_series(series: DataFrame) -> DataFrame:
    return forward_fill(month_grid(series))


def time_split(series: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Mark the first share of months of each series as train, the rest as test."""
    position = F.row_number().over(_per_series())
    length = F.count(F.lit(1)).over(Window.partitionBy("series_key"))
    part = F.when(position <= F.floor(length * F.lit(train_share)), "train").otherwise("test")
    return series.withColumn("part", part)
