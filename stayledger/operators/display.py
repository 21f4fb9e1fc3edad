"""Key figures as display texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.measures import dollars, mean_money, money, percent, percent_text, rows

# Names of the figures.
CANCELLATION_RATE, TOTAL, CANCELLED, CONFIRMED = (
    "Overall Cancellation Rate", "Total Bookings", "Cancelled Bookings", "Confirmed Bookings"
)
REVENUE, RATE, REVPAR, LOST = (
    "Total Revenue", "Average Daily Rate (ADR)", "RevPAR", "Potential Revenue Lost (Cancellations)"
)


def kpi_texts(df: DataFrame) -> DataFrame:
    """Cancellation and revenue figures as (figure, text), from one pass."""
    cancelled = F.sum("is_canceled")
    texts = {
        CANCELLATION_RATE: percent_text(percent("is_canceled"), 2),
        TOTAL: F.format_number(rows(), 0),
        CANCELLED: F.format_number(cancelled, 0),
        CONFIRMED: F.format_number(rows() - cancelled, 0),
        REVENUE: dollars(money("revenue")),
        RATE: dollars(mean_money("adr")),
        REVPAR: dollars(mean_money("adr") * (1 - F.avg("is_canceled"))),
        LOST: dollars(money(F.when(F.col("is_canceled") == 1, F.col("revenue")))),
    }
    wide = df.agg(*[text.alias(f"t{i}") for i, text in enumerate(texts.values())])
    lines = [F.struct(F.lit(name).alias("figure"), F.col(f"t{i}").alias("text")) for i, name in enumerate(texts)]
    return wide.select(F.inline(F.array(*lines)))
