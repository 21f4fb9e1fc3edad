"""Ordered buckets with right-closed borders, and grouping that keeps empty buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Buckets:
    """Borders b0 < b1 < ... and one label per interval (b0, b1], (b1, b2], ..., (bn, infinity)."""

    borders: tuple[int, ...]
    labels: tuple[str, ...]

    def label(self, value: str | Column) -> Column:
        """Label of a value; null at or below the first border."""
        column = F.col(value) if isinstance(value, str) else value
        expression = F.when(column > self.borders[-1], self.labels[-1])
        for low, high, name in zip(self.borders, self.borders[1:], self.labels):
            expression = expression.when((column > low) & (column <= high), name)
        return expression

    def label_from_zero(self, value: str | Column) -> Column:
        """As :meth:`label`, but everything up to the second border is in the first bucket."""
        column = F.col(value) if isinstance(value, str) else value
        expression = F.when(column <= self.borders[1], self.labels[0])
        for high, name in zip(self.borders[2:], self.labels[1:]):
            expression = expression.when(column <= high, name)
        return expression.when(column > self.borders[-1], self.labels[-1])

    def order(self, label: str | Column) -> Column:
        """Place of a label, null for any other text."""
        return F.nullif(F.array_position(F.array(*[F.lit(text) for text in self.labels]), label), F.lit(0).cast("long"))

    def table(self, spark, name: str) -> DataFrame:
        """The labels as rows (name, bucket_order)."""
        entries = F.array(
            *[F.struct(F.lit(text).alias(name), F.lit(i).alias("bucket_order")) for i, text in enumerate(self.labels)]
        )
        return spark.range(1).select(F.inline(entries))

    def with_all_labels(self, grouped: DataFrame, name: str) -> DataFrame:
        """Keep every label, also those without rows. The label side is a handful of literals."""
        return self.table(grouped.sparkSession, name).join(grouped, name, "left")


# Borders and labels.
LEAD_TIME = Buckets(
    (0, 7, 30, 90, 180, 365),
    ("0-7 days", "8-30 days", "31-90 days", "91-180 days", "181-365 days", "366+ days"),
)
STAY = Buckets(
    (0, 1, 2, 3, 5, 7, 14),
    ("0-1 nights", "2 nights", "3 nights", "4-5 nights", "6-7 nights", "8-14 nights", "15+ nights"),
)
