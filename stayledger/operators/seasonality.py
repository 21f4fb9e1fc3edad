"""Seasonal decomposition and autocorrelation, for many series at once.

A series has one row per month, so windows and groups per series are short by nature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_PERIOD = 12
MIN_LENGTH = 12


def _centred_mean(period: int, order: Window) -> Column:
    """Centred moving average; an even period weighs both ends by half. Null where the span is incomplete."""
    half = period // 2
    wide = order.rowsBetween(-half, half)
    full = F.count("observed").over(wide) == 2 * half + 1
    if period % 2:
        return F.when(full, F.sum("observed").over(wide) / period)
    narrow = order.rowsBetween(-half + 1, half - 1)
    return F.when(full, (F.sum("observed").over(wide) + F.sum("observed").over(narrow)) / (2 * period))


def seasonal_decomposition(series: DataFrame) -> DataFrame:
    """Multiplicative decomposition into trend, seasonal factor and residual.

    The period is 12, or half the length for series shorter than two years; series under 12 months are left out.
    Seasonal factors are means of the detrended values per phase, scaled to average 1.
    """
    order = Window.partitionBy("series_key").orderBy("month_start")
    whole = Window.partitionBy("series_key")
    indexed = series.select(
        "series_key",
        "month_start",
        F.col("value").cast("double").alias("observed"),
        (F.row_number().over(order) - 1).alias("_index"),
        F.count(F.lit(1)).over(whole).alias("_length"),
    ).filter(F.col("_length") >= MIN_LENGTH)
    period = F.least(F.lit(MAX_PERIOD), F.floor(F.col("_length") / 2))
    trend = reduce(
        lambda rest, p: F.when(F.col("_period") == p, _centred_mean(p, order)).otherwise(rest),
        range(MIN_LENGTH // 2, MAX_PERIOD + 1),
        F.lit(None).cast("double"),
    )
    trended = indexed.withColumn("_period", period).withColumn("trend", trend)
    phased = trended.withColumns(
        {"_phase": F.col("_index") % F.col("_period"), "_detrended": F.try_divide("observed", "trend")}
    )
    per_phase = Window.partitionBy("series_key", "_phase")
    averaged = phased.withColumn("_phase_mean", F.avg("_detrended").over(per_phase))
    # The mean over phases counts each phase once, whatever number of months it has.
    once = F.when(F.col("_index") < F.col("_period"), F.col("_phase_mean"))
    scaled = averaged.withColumn("seasonal", F.try_divide(F.col("_phase_mean"), F.avg(once).over(whole)))
    return scaled.select(
        "series_key", "month_start", "observed", "trend", "seasonal",
        F.try_divide(F.col("observed"), F.col("seasonal") * F.col("trend")).alias("resid"),
    )


def acf(series: DataFrame, max_lag: int = 12) -> DataFrame:
    """Autocorrelation per series and lag 0..min(40 % of the length, ``max_lag``)."""
    order = Window.partitionBy("series_key").orderBy("month_start")
    whole = Window.partitionBy("series_key")
    deviation = F.col("value") - F.avg("value").over(whole)
    centred = series.filter(F.col("value").isNotNull()).select("series_key", "month_start", deviation.alias("_d"))
    shifted = centred.select(
        "series_key", "_d", *[F.lag("_d", k).over(order).alias(f"_d{k}") for k in range(1, max_lag + 1)]
    )
    sums = shifted.groupBy("series_key").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("_d") * F.col("_d")).alias("_s0"),
        *[F.sum(F.col("_d") * F.col(f"_d{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    lines = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_s{k}").alias("_s")) for k in range(max_lag + 1)])
    return (
        sums.select("series_key", "_n", "_s0", F.inline(lines))
        .filter(F.col("lag") <= F.floor(F.col("_n") * F.lit(0.4)))
        .select("series_key", "lag", F.try_divide(F.col("_s"), F.col("_s0")).alias("value"))
    )


def _dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def pacf(series: DataFrame, max_lag: int = 12) -> DataFrame:
    """Partial autocorrelation per series by the Durbin-Levinson recursion on the autocorrelations.

    The recursion folds over an array of at most ``max_lag`` values, so it stays in the JVM.
    """
    lists = (
        acf(series, max_lag)
        .filter(F.col("lag") > 0)
        .groupBy("series_key")
        .agg(F.array_sort(F.collect_list(F.struct("lag", "value"))).getField("value").alias("_rho"))
    )

    def following(state: Column, k: Column) -> Column:
        """Coefficients of order k from those of order k - 1; the last one is the partial autocorrelation."""
        weights, rho = state.getField("weights"), F.col("_rho")
        lower = F.slice(rho, F.lit(1), k - 1)
        last = F.try_divide(F.element_at(rho, k) - _dot(weights, F.reverse(lower)), 1 - _dot(weights, lower))

        def extend(p: Column) -> Column:
            moved = F.zip_with(weights, F.reverse(weights), lambda a, b: a - p * b)
            return F.struct(
                F.concat(moved, F.array(p)).alias("weights"), F.concat(state.getField("found"), F.array(p)).alias("found")
            )

        # A one-element transform names the value, so that it is computed once.
        return F.element_at(F.transform(F.array(last), extend), 1)

    first = F.slice("_rho", 1, 1)
    start = F.struct(first.alias("weights"), first.alias("found"))
    orders = F.when(F.size("_rho") >= 2, F.sequence(F.lit(2), F.size("_rho"))).otherwise(F.array().cast("array<int>"))
    found = F.aggregate(orders, start, following, lambda state: state.getField("found"))
    values = lists.select("series_key", F.posexplode(F.concat(F.array(F.lit(1.0)), found)).alias("lag", "value"))
    alone = series.filter(F.col("value").isNotNull()).groupBy("series_key").agg(F.count(F.lit(1)).alias("_n"))
    short = alone.filter(F.floor(F.col("_n") * F.lit(0.4)) < 1).select("series_key", F.lit(0).alias("lag"), F.lit(1.0).alias("value"))
    return values.unionByName(short)
