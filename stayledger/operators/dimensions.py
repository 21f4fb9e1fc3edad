"""The five dimensions: distinct attribute combinations and their derived columns.

Each function returns the members without their key; the warehouse build numbers them in natural-key order, nulls last.
``distinct`` combines inside each task first, so a combination shared by most rows is not a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar

UNKNOWN = "Unknown"


def date_members(raw: DataFrame) -> DataFrame:
    """One row per arrival date. If a date comes with several week numbers, the lowest is kept."""
    dates = raw.groupBy(
        F.col("arrival_date_year").alias("year"),
        F.col("arrival_date_month").alias("month"),
        F.col("arrival_date_day_of_month").alias("day_of_month"),
    ).agg(F.min("arrival_date_week_number").alias("week_number"))
    full_date = calendar.arrival_date("year", "month", "day_of_month")
    return dates.select(
        "year", "month", "week_number", "day_of_month",
        full_date.alias("full_date"),
        calendar.is_weekend(full_date).alias("is_weekend"),
        calendar.season("month").alias("season"),
    )


def week_conflicts(raw: DataFrame) -> DataFrame:
    """Arrival dates that were reported with more than one week number."""
    keys = ["arrival_date_year", "arrival_date_month", "arrival_date_day_of_month"]
    weeks = raw.groupBy(*keys).agg(
        F.min("arrival_date_week_number").alias("lowest_week"), F.max("arrival_date_week_number").alias("highest_week")
    )
    return weeks.filter("lowest_week < highest_week")


def hotel_members(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("hotel").alias("hotel_name"), F.col("meal").alias("meal_plan"), "market_segment", "distribution_channel"
    ).distinct()


def customer_members(raw: DataFrame) -> DataFrame:
    """A missing country is a member of its own."""
    return raw.select("country", "customer_type", "deposit_type").distinct()


def room_members(raw: DataFrame) -> DataFrame:
    rooms = raw.select("reserved_room_type", "assigned_room_type").distinct()
    return rooms.withColumn("room_changed", ~F.col("reserved_room_type").eqNullSafe(F.col("assigned_room_type")))


def agent_id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))


def agent_members(raw: DataFrame) -> DataFrame:
    return raw.select(agent_id("agent").alias("agent_id"), agent_id("company").alias("company_id")).distinct()


# Per dimension: its key, the function that finds its members, and the columns that order them.
DIMENSIONS = {
    "date_dim": ("date_key", date_members, ["full_date", "year", "month", "day_of_month"]),
    "hotel_dim": ("hotel_key", hotel_members, ["hotel_name", "meal_plan", "market_segment", "distribution_channel"]),
    "customer_dim": ("customer_key", customer_members, ["country", "customer_type", "deposit_type"]),
    "room_dim": ("room_key", room_members, ["reserved_room_type", "assigned_room_type"]),
    "agent_dim": ("agent_key", agent_members, ["agent_id", "company_id"]),
}
