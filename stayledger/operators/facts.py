"""Booking facts: foreign keys found by null-safe joins, and the derived measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import sent_if_small
from .dimensions import agent_id

# Per dimension: key column and (raw column, dimension column) pairs that identify a member.
LOOKUPS = {
    "date_dim": ("date_key", [("arrival_date_year", "year"), ("arrival_date_month", "month"), ("arrival_date_day_of_month", "day_of_month")]),
    "hotel_dim": ("hotel_key", [("hotel", "hotel_name"), ("meal", "meal_plan"), ("market_segment", "market_segment"), ("distribution_channel", "distribution_channel")]),
    "customer_dim": ("customer_key", [("country", "country"), ("customer_type", "customer_type"), ("deposit_type", "deposit_type")]),
    "room_dim": ("room_key", [("reserved_room_type", "reserved_room_type"), ("assigned_room_type", "assigned_room_type")]),
    "agent_dim": ("agent_key", [("_agent_id", "agent_id"), ("_company_id", "company_id")]),
}
KEY_COLUMNS = [key for key, _ in LOOKUPS.values()]

MEASURES = [
    "is_canceled", "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies",
    "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes", "adr",
    "required_car_parking_spaces", "total_of_special_requests", "days_in_waiting_list", "reservation_status",
    "reservation_status_date",
]
DERIVED = ["total_stay_nights", "total_guests", "revenue"]
YEAR_PARTITION = "arrival_year"
MISSING_MEMBER_KEY = 1


def _look_up(rows: DataFrame, dimension: DataFrame, key: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Left join on the natural key where two nulls are equal.

    The dimension is read from files and sent to the executors as long as those are small, otherwise Catalyst shuffles
    with skewed keys split at run time.
    """
    members = sent_if_small(dimension).select(F.col(key).alias(f"_{key}"), *[F.col(d).alias(f"_{key}_{i}") for i, (_, d) in enumerate(pairs)])
    matches = [F.col(raw).eqNullSafe(F.col(f"_{key}_{i}")) for i, (raw, _) in enumerate(pairs)]
    condition = matches[0]
    for match in matches[1:]:
        condition = condition & match
    return rows.join(members, condition, "left").drop(*[f"_{key}_{i}" for i in range(len(pairs))])


def with_foreign_keys(raw: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Add the five keys; a row without a member keeps a null key."""
    rows = raw.withColumns({"_agent_id": agent_id("agent"), "_company_id": agent_id("company")})
    for name, (key, pairs) in LOOKUPS.items():
        rows = _look_up(rows, dimensions[name], key, pairs).withColumnRenamed(f"_{key}", key)
    return rows.drop("_agent_id", "_company_id")


def missing_keys(keyed: DataFrame) -> DataFrame:
    """Bookings without a member, per key. All zero after a full load."""
    return keyed.agg(*[F.count_if(F.col(key).isNull()).alias(key) for key in KEY_COLUMNS])


def with_default_key(keyed: DataFrame) -> DataFrame:
    """Bookings without a member point to member 1."""
    return keyed.withColumns({key: F.coalesce(F.col(key), F.lit(MISSING_MEMBER_KEY).cast("bigint")) for key in KEY_COLUMNS})


def with_derived_measures(rows: DataFrame) -> DataFrame:
    """Fill missing children with 0 and add nights, guests and revenue."""
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    filled = rows.fillna({"children": 0.0})
    return filled.withColumns(
        {
            "total_stay_nights": nights,
            "total_guests": F.col("adults") + F.col("children") + F.col("babies"),
            "revenue": F.col("adr") * nights,
        }
    )


def booking_facts(numbered: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Facts from numbered raw bookings, with the year of their date member.

    That is the booking's own year, null included; a booking without a date member has the year of the member it is
    pointed to. So ``arrival_year`` stands for the dimension's ``year`` in every query, and lays out the files.
    """
    found = with_foreign_keys(numbered, dimensions)
    dates = dimensions["date_dim"]
    default_year = dates.filter(F.col("date_key") == MISSING_MEMBER_KEY).select("year").first()
    year = F.when(F.col("date_key").isNull(), F.lit(default_year.year if default_year else None)).otherwise(F.col("arrival_date_year"))
    keyed = with_default_key(found.withColumn(YEAR_PARTITION, year.cast("bigint")))
    return with_derived_measures(keyed).select("booking_id", *KEY_COLUMNS, *MEASURES, *DERIVED, YEAR_PARTITION)
