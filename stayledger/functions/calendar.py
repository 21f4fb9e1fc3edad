"""Calendar expressions over arrival year, month name and day."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# English month names, season names and the months of each season.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
SEASON_NAMES = ["Winter", "Spring", "Summer", "Fall"]
SEASON_MONTHS = {
    "Winter": ["December", "January", "February"],
    "Spring": ["March", "April", "May"],
    "Summer": ["June", "July", "August"],
}


def month_number(month: str | Column) -> Column:
    """English month name to 1..12, null for any other text."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES])
    position = F.array_position(names, F.col(month) if isinstance(month, str) else month)
    return F.nullif(position, F.lit(0)).cast("int")


def arrival_date(year: str, month: str, day: str) -> Column:
    """Date from year, English month name and day of month; null when they do not form a date."""
    text = F.concat_ws("-", F.col(year), F.col(month), F.col(day))
    return F.when(
        F.col(year).isNotNull() & F.col(month).isNotNull() & F.col(day).isNotNull(),
        F.try_to_date(text, "yyyy-MMMM-d"),
    )


def is_weekend(day: str | Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(day) >= 5


def season(month: str) -> Column:
    """Season of an English month name."""
    expression = F.lit("Fall")
    for name, months in SEASON_MONTHS.items():
        expression = F.when(F.col(month).isin(months), name).otherwise(expression)
    return expression


def season_order(column: str) -> Column:
    """Winter 0, Spring 1, Summer 2, Fall 3."""
    names = F.array(*[F.lit(name) for name in SEASON_NAMES])
    return (F.nullif(F.array_position(names, F.col(column)), F.lit(0)) - 1).cast("int")


def year_month(year: str, month: str) -> Column:
    """Label such as ``2016-July``."""
    return F.concat_ws("-", F.col(year).cast("string"), F.col(month))


def month_start(year: str, month: str) -> Column:
    """First day of the month."""
    return F.make_date(F.col(year).cast("int"), month_number(month), F.lit(1))


def month_title(day: str | Column) -> Column:
    """Text such as ``July 2016``."""
    return F.date_format(day, "MMMM yyyy")
