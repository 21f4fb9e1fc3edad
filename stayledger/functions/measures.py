"""Small numeric and text expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_percent(flag: str | Column) -> Column:
    """Mean of a 0/1 flag in percent, as rankings need it."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(column) * 100


def percent(flag: str | Column) -> Column:
    """Mean of a 0/1 flag in percent, rounded for display."""
    return F.round(exact_percent(flag), 6)


def rows() -> Column:
    return F.count(F.lit(1))


def rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def mean_where(condition: Column, value: str) -> Column:
    return F.avg(F.when(condition, F.col(value)))


def _cents(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.round(column * 100).cast("bigint")


def money(value: str | Column) -> Column:
    """Sum of an amount, added in whole cents: exact, so the result does not depend on how rows are split over tasks."""
    return F.sum(_cents(value)) / F.lit(100.0)


def mean_money(value: str | Column) -> Column:
    """Mean of an amount, from the exact sum of cents."""
    return F.sum(_cents(value)) / (F.count(value) * F.lit(100.0))


def total_value() -> Column:
    return F.col("adr") * F.col("total_stay_nights")


def dollars(value: str | Column, decimals: int = 2) -> Column:
    """Text such as ``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(value, decimals))


def percent_text(value: str | Column, decimals: int = 1) -> Column:
    """Text such as ``37.0%`` from a number already in percent."""
    return F.concat(F.format_number(value, decimals), F.lit("%"))


def signed_percent_text(value: str | Column, decimals: int = 1) -> Column:
    """Text such as ``+3.2%``; a half goes to the even digit, as in the other texts."""
    return F.format_string(f"%+.{decimals}f%%", F.bround(value, decimals).cast("double"))


def customer_id(country: str = "country", parts: tuple[str, ...] = ("adults", "children", "babies")) -> Column:
    """Identifier of a guest party: country and party size joined by underscores, ``nan`` for a missing value."""
    pieces = [F.coalesce(F.col(name).cast("string"), F.lit("nan")) for name in (country, *parts)]
    return F.concat_ws("_", *pieces)
