"""Advice lines that carry figures from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import buckets
from ..functions.measures import exact_percent, mean_money, money

# Titles and sentence templates.
PRICING = "Dynamic Pricing Strategy"
ROOMS = "Room Type Optimization"
STAYS = "Length of Stay Strategy"
DEPOSITS = "Tiered Deposit Policy"
SEASON_LINES = [(PRICING, "Increase rates by 10-15%% during %s season")]
MARKET_LINES = [(PRICING, "Target %s segment with premium packages")]
ROOM_LINES = [
    (ROOMS, "Focus marketing on high-revenue room types like Room %s and offer strategic upsells from lower categories."),
    (ROOMS, "Highlight Room %s in marketing materials"),
]
STAY_LINES = [(STAYS, "Encourage %s stays through targeted promotions and pricing incentives.")]
LEAD_LINES = [(DEPOSITS, "Require deposits for %s bookings")]
CANCEL_MARKET_LINES = [(DEPOSITS, "Focus on %s market segment")]


def _lines(best: DataFrame, templates: dict[str, list[tuple[str, str]]]) -> DataFrame:
    """An advice row per template of each category, filled with the category's best value."""
    texts = F.array().cast("array<struct<title:string,detail:string>>")
    for name, lines in templates.items():
        made = F.array(*[F.struct(F.lit(title).alias("title"), F.format_string(text, F.col("best")).alias("detail")) for title, text in lines])
        texts = F.when(F.col("category") == name, made).otherwise(texts)
    return best.select(F.inline(texts))


def _best_of_each(df: DataFrame, categories: list[str], rank: Column, measures: list[Column]) -> DataFrame:
    """(category, best): for each of several categories the value with the lowest ``rank``, which may use the category's name,
    its value and the measures, from one pass over the rows. Ties go to the smaller value."""
    sets = df.groupingSets([[F.col(c)] for c in categories], *categories).agg(*measures, *[F.grouping(c).alias(f"_{c}") for c in categories])
    category, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in categories:
        category = F.when(F.col(f"_{name}") == 0, name).otherwise(category)
        value = F.when(F.col(f"_{name}") == 0, F.col(name)).otherwise(value)
    named = sets.withColumns({"category": category, "value": value}).filter("value IS NOT NULL")
    return named.groupBy("category").agg(F.min_by("value", F.struct(rank, "value")).alias("best"))


def revenue_advice(df: DataFrame) -> DataFrame:
    """Advice naming the best season, market segment, room type and stay length: highest revenue, room types by mean rate."""
    stay = "stay_duration_bucket"
    rows = df.withColumn(stay, buckets.STAY.label("total_stay_nights"))
    by_rate = F.col("category") == "reserved_room_type"
    rank = F.struct(-F.when(by_rate, F.col("rate")).otherwise(F.col("total")), F.when(F.col("category") == stay, buckets.STAY.order("value")))
    best = _best_of_each(rows, ["season", "market_segment", "reserved_room_type", stay], rank, [money("revenue").alias("total"), mean_money("adr").alias("rate")])
    return _lines(best, {"season": SEASON_LINES, "market_segment": MARKET_LINES, "reserved_room_type": ROOM_LINES, stay: STAY_LINES})


def cancellation_advice(df: DataFrame) -> DataFrame:
    """Advice naming the lead-time bucket and the market segment that cancel most."""
    bucket = "lead_time_bucket"
    rows = df.withColumn(bucket, buckets.LEAD_TIME.label("lead_time"))
    rank = F.struct(-F.col("rate"), F.when(F.col("category") == bucket, buckets.LEAD_TIME.order("value")))
    best = _best_of_each(rows, [bucket, "market_segment"], rank, [exact_percent("is_canceled").alias("rate")])
    return _lines(best, {bucket: LEAD_LINES, "market_segment": CANCEL_MARKET_LINES})
