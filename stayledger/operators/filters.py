"""Optional filters and projections over the joined bookings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

# Column lists of the joined views, in order.
WIDE_COLUMNS = [
    "booking_id", "is_canceled", "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children",
    "babies", "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes", "adr",
    "required_car_parking_spaces", "total_of_special_requests", "days_in_waiting_list", "total_stay_nights",
    "total_guests", "revenue", "year", "month", "week_number", "day_of_month", "season", "hotel_name", "meal_plan",
    "market_segment", "distribution_channel", "country", "customer_type", "deposit_type", "reserved_room_type",
    "assigned_room_type", "room_changed", "reservation_status", "reservation_status_date",
]
CANCELLATION_COLUMNS = [
    c for c in WIDE_COLUMNS if c not in ("week_number", "day_of_month", "reservation_status", "reservation_status_date")
] + ["is_weekend"]
CHURN_COLUMNS = [c for c in WIDE_COLUMNS if c not in ("week_number", "day_of_month", "revenue")]
DETAIL_COLUMNS = [
    "hotel_name", "reservation_status", "year", "month", "lead_time", "total_stay_nights", "adults", "children", "adr",
    "revenue", "market_segment", "distribution_channel", "is_repeated_guest",
]


def apply_filters(
    df: DataFrame,
    hotel: str | None = None,
    years: tuple[int, int] | None = None,
    segment: str | None = None,
    customer_type: str | None = None,
    exclude_cancelled: bool = False,
) -> DataFrame:
    """Keep bookings of one hotel, an inclusive range of years, one market segment, one customer type.

    Figures include cancelled bookings unless ``exclude_cancelled`` is set.
    """
    for column, value in (("hotel_name", hotel), ("market_segment", segment), ("customer_type", customer_type)):
        if value is not None:
            df = df.filter(F.col(column) == value)
    if years is not None:
        df = df.filter(F.col("year").between(*years))
    if exclude_cancelled:
        df = df.filter(F.col("is_canceled") == 0)
    return df


def filter_options(hotels: DataFrame, years: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct values to choose from, and the first and last year.

    Takes the three small dimension tables: every member was seen in at least one booking.
    """
    def values(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.lit(name).alias("filter_name"), F.col(name).alias("option")).distinct()

    bounds = years.agg(F.min("year").alias("min_year"), F.max("year").alias("max_year"))
    limits = [
        bounds.select(F.lit(name).alias("filter_name"), F.col(name).cast("string").alias("option"))
        for name in ("min_year", "max_year")
    ]
    choices = [values(hotels, "hotel_name"), values(hotels, "market_segment"), values(customers, "customer_type")]
    return reduce(DataFrame.unionByName, choices + limits).orderBy("filter_name", "option")


DETAIL_ROWS = 100


def booking_detail(df: DataFrame, limit: int = DETAIL_ROWS) -> DataFrame:
    """The first bookings for display."""
    return df.select("booking_id", *DETAIL_COLUMNS).orderBy("booking_id").limit(limit)
