"""Column layout of raw bookings."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "date": T.DateType()}

# The 32 raw columns in file order.
RAW_COLUMNS = {
    "hotel": "string",
    "is_canceled": "int",
    "lead_time": "long",
    "arrival_date_year": "long",
    "arrival_date_month": "string",
    "arrival_date_week_number": "long",
    "arrival_date_day_of_month": "long",
    "stays_in_weekend_nights": "long",
    "stays_in_week_nights": "long",
    "adults": "long",
    "children": "double",
    "babies": "long",
    "meal": "string",
    "country": "string",
    "market_segment": "string",
    "distribution_channel": "string",
    "is_repeated_guest": "int",
    "previous_cancellations": "long",
    "previous_bookings_not_canceled": "long",
    "reserved_room_type": "string",
    "assigned_room_type": "string",
    "booking_changes": "long",
    "deposit_type": "string",
    "agent": "long",
    "company": "long",
    "days_in_waiting_list": "long",
    "customer_type": "string",
    "adr": "double",
    "required_car_parking_spaces": "long",
    "total_of_special_requests": "long",
    "reservation_status": "string",
    "reservation_status_date": "date",
}

# Text that stands for a missing value (the default tokens of pandas 1.5).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "n/a", "nan", "null",
]


def typed(name: str) -> T.DataType:
    """Spark type of a raw column."""
    return _TYPES[RAW_COLUMNS[name]]
