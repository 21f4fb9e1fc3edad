"""Churn labels from booking history, with a rule per booking where history says nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import customer_id, percent, rows
from ..session import stored
from .skew import left_join_on_counted_key

SILENCE_FACTOR = 1.5  # fixed value: silence longer than 1.5 x the mean gap counts as churn


def with_customer_id(df: DataFrame) -> DataFrame:
    return df.withColumn("customer_id", customer_id())


def customer_rollup(df: DataFrame) -> DataFrame:
    """Per customer: bookings, rates, first and last date, mean gap between bookings and days of silence.

    The gaps between sorted dates add up to last minus first, so no list of dates is needed: a customer with any
    number of bookings is a handful of sums, combined inside each task. Silence runs to the last date of all rows.
    """
    history = df.groupBy("customer_id").agg(
        rows().alias("bookings"),
        F.avg("is_canceled").alias("cancel_rate"),
        F.max("is_repeated_guest").alias("any_repeat"),
        F.min("reservation_status_date").alias("first_date"),
        F.max("reservation_status_date").alias("last_date"),
    )
    last_day = history.agg(F.max("last_date").alias("last_day")).scalar()
    span = F.date_diff("last_date", "first_date")
    return history.withColumns(
        {
            "avg_return_gap_days": F.when(F.col("bookings") > 1, span / (F.col("bookings") - 1)),
            "days_since_last_booking": F.date_diff(last_day, "last_date"),
        }
    )


def customer_label(rollup: DataFrame) -> DataFrame:
    """1 churned, 0 not, null when a single booking gives no history."""
    silent = F.col("days_since_last_booking") > F.col("avg_return_gap_days") * SILENCE_FACTOR
    label = F.when(F.col("bookings") <= 1, None).when(F.col("any_repeat") == 1, 0).when(silent, 1).otherwise(0)
    return rollup.withColumn("history_label", label.cast("int"))


def history_labels(df: DataFrame) -> DataFrame:
    """customer_id, bookings and history_label of every customer."""
    return customer_label(customer_rollup(with_customer_id(df))).select("customer_id", "bookings", "history_label")


def with_churn_label(df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Add ``customer_id`` and ``is_churned`` to every booking. ``labels`` are the stored :func:`history_labels` of all
    bookings, if known."""
    identified = with_customer_id(df)
    # The labels are read three times by the join, so the pass over all bookings behind them is done once.
    labels = stored(history_labels(df), "history-labels") if labels is None else labels
    labelled = left_join_on_counted_key(identified, labels, "customer_id", "bookings", "history_label")
    unhappy = (F.col("is_canceled") == 1) | ((F.col("booking_changes") > 0) & F.col("room_changed"))
    return labelled.withColumn(
        "is_churned", F.coalesce(F.col("history_label"), F.when(unhappy, 1).otherwise(0)).cast("int")
    ).drop("history_label")


def churn_summary(labelled: DataFrame) -> DataFrame:
    churned = F.coalesce(F.sum("is_churned"), F.lit(0))
    return labelled.agg(
        percent("is_churned").alias("churn_rate"), churned.alias("churned"), (rows() - churned).alias("not_churned")
    )
