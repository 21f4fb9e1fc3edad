"""Demand forecasts: a simple seasonal baseline, and seasonal ARIMA for many series in one job.

Spark shuffles the monthly rows of each series together (at most one row per calendar month) and fits the series in
parallel; the fitted parameters are an ordinary table that can be stored and used later.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar

# The functions below travel with their tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASONAL_LENGTH = 12
NORMAL_95 = 1.959963984540054
PARAMETERS = (
    "series_key string, last_month date, d int, seasonal_d int, constant double, sigma double, "
    "ar_lags array<int>, ar array<double>, ma_lags array<int>, ma array<double>, "
    "recent_values array<double>, recent_errors array<double>"
)
FORECASTS = "series_key string, date date, predicted_bookings double, lower_ci double, upper_ci double"

# Seasonal factors, growth per month and interval width of the baseline.
BASELINE_SUMMER, BASELINE_SUMMER_FACTOR = [6, 7, 8], 1.2
BASELINE_WINTER, BASELINE_WINTER_FACTOR = [11, 12, 1], 0.8
BASELINE_GROWTH = 1.02
BASELINE_LOWER, BASELINE_UPPER = 0.85, 1.15


def baseline_forecast(series: DataFrame, periods: int = 6) -> DataFrame:
    """Last value x seasonal factor x growth, in whole bookings, for the months after the last one of each series."""
    last = series.groupBy("series_key").agg(
        F.max("month_start").alias("_last"), F.max_by("value", "month_start").alias("_value")
    )
    steps = last.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("_step"))
    month = F.add_months("_last", F.col("_step"))
    number = F.month(month)
    factor = (
        F.when(number.isin(BASELINE_SUMMER), BASELINE_SUMMER_FACTOR)
        .when(number.isin(BASELINE_WINTER), BASELINE_WINTER_FACTOR)
        .otherwise(1.0)
    )
    grown = F.col("_value") * factor * F.pow(F.lit(BASELINE_GROWTH), F.col("_step"))
    whole = F.greatest(F.lit(0), grown.cast("bigint"))
    return steps.select("series_key", month.alias("month_start"), whole.alias("bookings")).select(
        "*",
        F.greatest(F.lit(0), (F.col("bookings") * F.lit(BASELINE_LOWER)).cast("bigint")).alias("lower_ci"),
        (F.col("bookings") * F.lit(BASELINE_UPPER)).cast("bigint").alias("upper_ci"),
    )


def forecast_summary(forecast: DataFrame) -> DataFrame:
    """Peak and lowest month (the earlier one on a tie), total and whole-number mean per series."""
    early = F.struct(F.col("bookings"), -F.unix_date("month_start"))
    late = F.struct(F.col("bookings"), F.unix_date("month_start"))
    return forecast.groupBy("series_key").agg(
        calendar.month_title(F.max_by("month_start", early)).alias("peak_month"),
        F.max("bookings").alias("peak_value"),
        calendar.month_title(F.min_by("month_start", late)).alias("low_month"),
        F.min("bookings").alias("low_value"),
        F.sum("bookings").alias("total"),
        F.avg("bookings").cast("bigint").alias("average"),
    )


def demand_outlook(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """History and forecast in one table, with year and month name."""
    def part(df: DataFrame, kind: str, bookings: Column, lower: Column, upper: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            F.year("month_start").alias("year"),
            F.date_format("month_start", "MMMM").alias("month"),
            bookings.cast("bigint").alias("bookings"),
            lower.cast("bigint").alias("lower_ci"),
            upper.cast("bigint").alias("upper_ci"),
        )

    nothing = F.lit(None)
    past = part(history, "history", F.col("value"), nothing, nothing)
    return past.unionByName(part(forecast, "forecast", F.col("bookings"), F.col("lower_ci"), F.col("upper_ci")))


def seasonal_naive(series: DataFrame) -> DataFrame:
    """Predict each month by the value twelve months earlier in a gap-free series."""
    order = Window.partitionBy("series_key").orderBy("month_start")
    return series.withColumn("predicted", F.lag("value", SEASONAL_LENGTH).over(order))


def forecast_metrics(predictions: DataFrame, actual: str = "value", predicted: str = "predicted") -> DataFrame:
    """Root mean squared error, mean absolute error and R2 per series; R2 is null for a constant series."""
    error = F.col(actual) - F.col(predicted)
    squares = F.var_pop(F.col(actual)) * F.count(F.lit(1))
    known = predictions.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return known.groupBy("series_key").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), squares)).alias("r2"),
    )


def _lags(short: int, long: int, season: int) -> list[int]:
    """Lags of the product of a short and a seasonal polynomial, without lag 0."""
    return sorted({i + season * j for i in range(short + 1) for j in range(long + 1)} - {0})


def _lagged(values: np.ndarray, lags: list[int], start: int) -> np.ndarray:
    return np.column_stack([values[start - k : len(values) - k] for k in lags]) if lags else np.empty((len(values) - start, 0))


def _difference(values: np.ndarray, d: int, seasonal_d: int, season: int) -> np.ndarray:
    for step in [1] * d + [season] * seasonal_d:
        values = values[step:] - values[:-step]
    return values


def _fit(values: np.ndarray, order: tuple[int, int, int], seasonal: tuple[int, int, int, int]) -> dict:
    """Two-step least squares (Hannan and Rissanen, 1982): a long autoregression estimates the errors, a second
    regression uses the values and errors at the model's lags. A series too short for that gets the value of one
    season (or one month) earlier plus the mean change.
    """
    (p, d, q), (sp, sd, sq, season) = order, seasonal
    ar_lags, ma_lags = _lags(p, sp, season), _lags(q, sq, season)
    reach = max(ar_lags + ma_lags, default=0)
    if len(values) > d + season * sd + 2 * reach + len(ar_lags) + len(ma_lags) + 2:
        w = _difference(values, d, sd, season)
        long_lags = list(range(1, reach + 1))
        errors = np.zeros(len(w))
        if long_lags:
            past = _lagged(w, long_lags, reach)
            errors[reach:] = w[reach:] - past @ np.linalg.lstsq(past, w[reach:], rcond=None)[0]
        start = 2 * reach
        design = np.hstack([_lagged(w, ar_lags, start), _lagged(errors, ma_lags, start)])
        weights = np.linalg.lstsq(design, w[start:], rcond=None)[0]
        rest = w[start:] - design @ weights
        errors[start:] = rest
        free = max(1, len(rest) - len(weights))
        fit = {"d": d, "seasonal_d": sd, "constant": 0.0, "sigma": float(np.sqrt(rest @ rest / free))}
        fit |= {"ar_lags": ar_lags, "ar": weights[: len(ar_lags)], "ma_lags": ma_lags, "ma": weights[len(ar_lags) :]}
    else:
        use_season = len(values) > season
        w = _difference(values, int(not use_season and len(values) > 1), int(use_season), season)
        change = float(w.mean()) if len(values) > 1 else 0.0
        spread = float(np.std(w)) if len(values) > 1 else 0.0
        fit = {"d": int(not use_season), "seasonal_d": int(use_season), "constant": change, "sigma": spread}
        fit |= {"ar_lags": [], "ar": [], "ma_lags": [], "ma": []}
        errors = np.zeros(1)
    keep = d + fit["d"] + season * (sd + fit["seasonal_d"]) + reach + 1
    return fit | {"recent_values": values[-keep:], "recent_errors": errors[-(reach + 1) :]}


def _predict(fit: dict, periods: int, season: int = SEASONAL_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Means and standard errors of the next months, from the polynomial that includes the differences."""
    poly = np.zeros(max(fit["ar_lags"], default=0) + 1)
    poly[0] = 1.0
    for lag, weight in zip(fit["ar_lags"], fit["ar"]):
        poly[lag] -= weight
    for step in [1] * fit["d"] + [season] * fit["seasonal_d"]:
        poly = np.convolve(poly, np.concatenate([[1.0], np.zeros(step - 1), [-1.0]]))
    ma = dict(zip(fit["ma_lags"], fit["ma"]))
    values, errors = list(fit["recent_values"]), list(fit["recent_errors"])
    psi: list[float] = []
    for h in range(periods):
        past = sum(-c * values[-i] for i, c in enumerate(poly) if i and i <= len(values))
        shocks = sum(w * errors[h - lag] for lag, w in ma.items() if lag > h and lag - h <= len(errors))
        values.append(fit["constant"] + past + shocks)
        known = sum(-poly[i] * psi[h - i] for i in range(1, min(h, len(poly) - 1) + 1))
        psi.append(1.0 if h == 0 else ma.get(h, 0.0) + known)
    means = np.array(values[len(values) - periods :])
    return means, fit["sigma"] * np.sqrt(np.cumsum(np.square(psi)))


def fit_sarima(
    series: DataFrame, order: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int, int] = (1, 0, 0, 12)
) -> DataFrame:
    """Fit every gap-free series; one row of parameters per series."""
    needed = series.select("series_key", "month_start", "value")
    return needed.groupBy("series_key").applyInPandas(_fitter(order, seasonal), PARAMETERS)


def _fitter(order: tuple[int, int, int], seasonal: tuple[int, int, int, int]):
    def fit_one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("month_start")
        fit = _fit(rows["value"].to_numpy(dtype=float), order, seasonal)
        return pd.DataFrame([{"series_key": rows["series_key"].iloc[0], "last_month": rows["month_start"].iloc[-1], **fit}])

    return fit_one


def forecast_from(parameters: DataFrame, periods: int = 12, season: int = SEASONAL_LENGTH) -> DataFrame:
    """Forecast the months after the last one of each fitted series, with a 95 % interval."""

    def forecast(batches):
        for batch in batches:
            frames = [_forecast_frame(row, periods, season) for row in batch.to_dict("records")]
            yield pd.concat(frames) if frames else pd.DataFrame(columns=[c.split()[0] for c in FORECASTS.split(", ")])

    return parameters.mapInPandas(forecast, FORECASTS)


def _forecast_frame(row: dict, periods: int, season: int) -> pd.DataFrame:
    means, spread = _predict(row, periods, season)
    dates = pd.date_range(pd.Timestamp(row["last_month"]), periods=periods + 1, freq="MS")[1:].date
    return pd.DataFrame(
        {
            "series_key": row["series_key"],
            "date": dates,
            "predicted_bookings": means,
            "lower_ci": means - NORMAL_95 * spread,
            "upper_ci": means + NORMAL_95 * spread,
        }
    )


def holdout_predictions(
    split: DataFrame, order: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int, int] = (1, 0, 0, 12)
) -> DataFrame:
    """Fit each series on its train months and predict its test months: (series_key, month_start, value, predicted)."""

    def predict(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("month_start")
        train, test = rows[rows["part"] == "train"], rows[rows["part"] == "test"]
        means = np.full(len(test), np.nan)
        if len(train) and len(test):
            means = _predict(_fit(train["value"].to_numpy(dtype=float), order, seasonal), len(test), seasonal[3])[0]
        return pd.DataFrame(
            {"series_key": test["series_key"], "month_start": test["month_start"], "value": test["value"].astype(float), "predicted": means}
        )

    return split.groupBy("series_key").applyInPandas(predict, "series_key string, month_start date, value double, predicted double")


OUTLOOK = "series_key string, kind string, month_start date, value double, predicted double, lower_ci double, upper_ci double"


def model_outlook(
    split: DataFrame, periods: int = 12, order: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int, int] = (1, 1, 1, 12)
) -> DataFrame:
    """Every series with what the model says of it: its months up to the split (``history``), the held-out months with the
    forecast made from the months before them (``holdout``), and ``periods`` months after the last one (``forecast``), the
    last two with a 95 % interval from the error weights of the fitted polynomials.

    ``split`` is a gap-free series with its parts, see :func:`demand.time_split`. Both fits of a series are made in one pass
    over it: one on its train months, one on all of them.
    """

    def outlook(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("month_start")
        train, test = rows[rows["part"] == "train"], rows[rows["part"] == "test"]
        parts = [pd.DataFrame({"kind": "history", "month_start": train["month_start"], "value": train["value"].astype(float)})]
        if len(test):
            parts.append(pd.DataFrame({"kind": "holdout", "month_start": test["month_start"], "value": test["value"].astype(float)}))
            if len(train):
                parts[-1] = parts[-1].assign(**_interval(train, len(test), order, seasonal))
        ahead = pd.date_range(pd.Timestamp(rows["month_start"].iloc[-1]), periods=periods + 1, freq="MS")[1:].date
        parts.append(pd.DataFrame({"kind": "forecast", "month_start": ahead, **_interval(rows, periods, order, seasonal)}))
        whole = pd.concat(parts, ignore_index=True).assign(series_key=rows["series_key"].iloc[0])
        return whole.reindex(columns=[c.split()[0] for c in OUTLOOK.split(", ")])

    return split.groupBy("series_key").applyInPandas(outlook, OUTLOOK)


def _interval(rows: pd.DataFrame, periods: int, order: tuple[int, int, int], seasonal: tuple[int, int, int, int]) -> dict[str, np.ndarray]:
    means, spread = _predict(_fit(rows["value"].to_numpy(dtype=float), order, seasonal), periods, seasonal[3])
    return {"predicted": means, "lower_ci": means - NORMAL_95 * spread, "upper_ci": means + NORMAL_95 * spread}


def outlook_forecast(outlook: DataFrame) -> DataFrame:
    """The future months of :func:`model_outlook` in whole bookings, none below 0, for :func:`forecast_summary` and
    :func:`demand_outlook`."""
    whole = lambda c: F.greatest(F.lit(0), F.round(c).cast("bigint"))
    future = outlook.filter("kind = 'forecast'")
    return future.select("series_key", "month_start", whole("predicted").alias("bookings"), whole("lower_ci").alias("lower_ci"), whole("upper_ci").alias("upper_ci"))


def outlook_history(outlook: DataFrame) -> DataFrame:
    """The known months of :func:`model_outlook`, held-out ones included."""
    return outlook.filter("kind <> 'forecast'").select("series_key", "month_start", "value")
