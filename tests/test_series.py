"""Grids, decomposition, autocorrelation and forecasts against small numpy calculations."""

import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from stayledger.operators import demand, forecasting, seasonality
from stayledger.plans import model_flows


def series_of(spark, values, start="2010-01-01", key="all"):
    months = pd.date_range(start, periods=len(values), freq="MS").date
    return spark.createDataFrame([(key, m, float(v)) for m, v in zip(months, values)], "series_key string, month_start date, value double")


def wave(n, seed=5):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 200 + 2 * t + 40 * np.sin(2 * np.pi * t / 12) + rng.normal(0, 3, n)


def test_missing_month_is_filled(spark):
    rows = [("a", "2016-01-01", 5), ("a", "2016-03-01", 7), ("b", "2016-11-01", 1), ("b", "2017-02-01", 2)]
    df = spark.createDataFrame(rows, "series_key string, d string, value long").select("series_key", F.to_date("d").alias("month_start"), "value")
    grid = demand.month_grid(df).orderBy("series_key", "month_start").collect()
    assert [r.value for r in grid] == [5, None, 7, 1, None, None, 2]
    filled = demand.complete_series(df).orderBy("series_key", "month_start").collect()
    assert [r.value for r in filled] == [5, 5, 7, 1, 1, 1, 2]


def test_split_of_26_months(spark):
    parts = [r.part for r in demand.time_split(series_of(spark, range(26))).orderBy("month_start").collect()]
    assert parts.count("train") == 20 and parts[:20] == ["train"] * 20


@pytest.mark.parametrize("n", [12, 13, 15, 17, 23, 24, 60])
def test_decomposition(spark, n):
    values = wave(n)
    out = seasonality.seasonal_decomposition(series_of(spark, values)).orderBy("month_start").toPandas()
    period = min(12, n // 2)
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
    trend = np.full(n, np.nan)
    half = len(weights) // 2
    trend[half : n - half] = np.convolve(values, weights, mode="valid")
    means = np.array([np.nanmean((values / trend)[i::period]) for i in range(period)])
    seasonal = (means / means.mean())[np.arange(n) % period]
    np.testing.assert_allclose(out.trend.astype(float), trend, rtol=1e-9)
    np.testing.assert_allclose(out.seasonal.astype(float), seasonal, rtol=1e-9)
    known = ~np.isnan(trend)
    np.testing.assert_allclose((out.trend * out.seasonal * out.resid)[known].astype(float), values[known], rtol=1e-9)


def test_short_series_is_not_decomposed(spark):
    assert seasonality.seasonal_decomposition(series_of(spark, wave(11))).count() == 0


def test_autocorrelations(spark):
    values = wave(40)
    d = values - values.mean()
    rho = np.array([d[: len(d) - k] @ d[k:] for k in range(13)]) / (d @ d)
    both = series_of(spark, values).unionByName(series_of(spark, wave(10, 9), key="short"))
    out = seasonality.acf(both).toPandas()
    assert out[out.series_key == "short"].lag.max() == 4
    np.testing.assert_allclose(out[out.series_key == "all"].sort_values("lag").value, rho, rtol=1e-9)
    partial = seasonality.pacf(both).toPandas()
    partial = partial[partial.series_key == "all"].sort_values("lag").value.to_numpy()
    phi = [1.0]  # Durbin-Levinson recursion
    row = np.array([])
    for k in range(1, 13):
        last = (rho[k] - row @ rho[k - 1 : 0 : -1]) / (1 - row @ rho[1:k]) if k > 1 else rho[1]
        row = np.r_[row - last * row[::-1], last]
        phi.append(last)
    np.testing.assert_allclose(partial, phi, rtol=1e-6)


def test_baseline_forecast(spark):
    out = forecasting.baseline_forecast(series_of(spark, [90, 100], "2016-04-01"), 3).orderBy("month_start").collect()
    assert [str(r.month_start) for r in out] == ["2016-06-01", "2016-07-01", "2016-08-01"]
    assert [r.bookings for r in out] == [int(100 * 1.2 * 1.02**h) for h in (1, 2, 3)]
    assert [(r.lower_ci, r.upper_ci) for r in out] == [(int(r.bookings * 0.85), int(r.bookings * 1.15)) for r in out]
    summary = forecasting.forecast_summary(forecasting.baseline_forecast(series_of(spark, [100], "2016-05-01"), 6)).first()
    assert summary.peak_month == "August 2016" and summary.low_month == "November 2016"


def test_summary_takes_the_first_on_a_tie(spark):
    rows = [("all", f"2016-0{m}-01", v) for m, v in ((1, 5), (2, 9), (3, 9), (4, 5))]
    df = spark.createDataFrame(rows, "series_key string, d string, bookings long").withColumn("month_start", F.to_date("d"))
    row = forecasting.forecast_summary(df).first()
    assert (row.peak_month, row.low_month, row.total, row.average) == ("February 2016", "January 2016", 28, 7)


def test_sarima_follows_a_seasonal_series(spark, tmp_path):
    values = wave(96)
    both = series_of(spark, values[:84]).unionByName(series_of(spark, values[:84] * 3, key="triple"))
    fitted = forecasting.fit_sarima(both, (1, 1, 1), (1, 1, 1, 12))
    fitted.write.parquet(str(tmp_path / "parameters"))
    loaded = spark.read.parquet(str(tmp_path / "parameters"))
    out = forecasting.forecast_from(loaded, 12).toPandas().sort_values(["series_key", "date"])
    one, three = out[out.series_key == "all"], out[out.series_key == "triple"]
    assert str(one.date.iloc[0]) == "2017-01-01" and len(one) == 12
    assert np.abs(one.predicted_bookings.to_numpy() - values[84:]).mean() < 15
    np.testing.assert_allclose(three.predicted_bookings, 3 * one.predicted_bookings.to_numpy(), rtol=1e-6)
    width = (one.upper_ci - one.lower_ci).to_numpy()
    assert (np.diff(width) >= -1e-9).all() and (width > 0).all()
    again = forecasting.forecast_from(fitted, 12).toPandas().sort_values(["series_key", "date"])
    np.testing.assert_allclose(again.predicted_bookings, out.predicted_bookings)


def test_sarima_matches_a_known_model():
    """An exact AR(1) in the differences is found, and the forecast continues it."""
    steps = [10.0]
    for _ in range(40):
        steps.append(steps[-1] * 0.5)
    values = np.cumsum(steps)
    fit = forecasting._fit(values, (1, 1, 0), (0, 0, 0, 12))
    means, spread = forecasting._predict(fit, 2)
    assert fit["ar"][0] == pytest.approx(0.5) and means[0] == pytest.approx(values[-1] + steps[-1] * 0.5)
    assert spread[0] == pytest.approx(0, abs=1e-6)


def test_psi_weights_of_a_random_walk():
    fit = {"d": 1, "seasonal_d": 0, "constant": 0.0, "sigma": 2.0, "ar_lags": [], "ar": [], "ma_lags": [], "ma": [], "recent_values": [1.0, 4.0], "recent_errors": [0.0]}
    means, spread = forecasting._predict(fit, 3)
    np.testing.assert_allclose(means, 4.0)
    np.testing.assert_allclose(spread, 2 * np.sqrt([1, 2, 3]))


@pytest.mark.parametrize("n", [1, 2, 5, 12, 13, 20, 30])
def test_short_series_still_get_a_forecast(spark, n):
    out = forecasting.forecast_from(forecasting.fit_sarima(series_of(spark, wave(n)), (1, 1, 1), (1, 1, 1, 12)), 12).toPandas()
    assert len(out) == 12 and np.isfinite(out.predicted_bookings).all()
    assert (out.lower_ci <= out.upper_ci).all()


def test_forecast_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 4.0, 3.0), ("b", 4.0, None)], "series_key string, value double, predicted double")
    out = {r.series_key: r for r in forecasting.forecast_metrics(df).collect()}
    assert out["a"].rmse == pytest.approx(0.5**0.5) and out["a"].mae == 0.5 and out["a"].r2 == 0.5
    assert out["b"].r2 is None and out["b"].mae == 1.0


def test_one_hotel_and_whole_flow(house):
    one = model_flows.demand_series(house, hotel="City Hotel")
    total = one.agg(F.sum("value")).first()[0]
    assert total == house.star("hotel_name").filter("hotel_name = 'City Hotel'").count()
    metrics, forecast = model_flows.forecast_demand(house, parts=("hotel_name",), periods=3)
    assert metrics.count() == 2 and forecast.count() == 6


def test_fit_runs_where_the_package_is_not_installed(tmp_path):
    rows = pd.DataFrame({"series_key": "a", "month_start": pd.date_range("2010-01-01", periods=60, freq="MS"), "value": wave(60)})
    (tmp_path / "task.bin").write_bytes(cloudpickle.dumps((forecasting._fitter((1, 1, 1), (1, 1, 1, 12)), rows)))
    code = "import sys; from pyspark import cloudpickle; f, rows = cloudpickle.load(open(sys.argv[1], 'rb')); assert 'stayledger' not in sys.modules; print(len(f(rows)))"
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path / "task.bin")], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin"}, timeout=120)
    assert done.stdout.strip() == "1", done.stderr


def test_outlook_of_a_small_series_by_hand(spark):
    """Without seasonal or moving-average part: an autoregression on the differences, recomputed with plain sums."""
    rng = np.random.default_rng(5)
    values = np.round(np.cumsum(rng.normal(size=40)) * 3 + 100, 3)
    months = pd.date_range("2015-01-01", periods=40, freq="MS").date
    rows = [("s", m, float(v), "train" if i < 32 else "test") for i, (m, v) in enumerate(zip(months, values))]
    split = spark.createDataFrame(rows, "series_key string, month_start date, value double, part string")
    found = forecasting.model_outlook(split, 5, (1, 1, 0), (0, 0, 0, 12)).toPandas().sort_values("month_start")
    assert list(found.kind) == ["history"] * 32 + ["holdout"] * 8 + ["forecast"] * 5

    def by_hand(known, periods):
        w = np.diff(known)
        y, x = w[2:], w[1:-1]  # the long autoregression takes one month, the regression starts after another
        phi = (x @ y) / (x @ x)
        sigma = np.sqrt(((y - phi * x) ** 2).sum() / (len(y) - 1))
        means, spread, last, change, total = [], [], known[-1], w[-1], 0.0
        for h in range(periods):
            change = phi * change
            last += change
            total += sum(phi**k for k in range(h + 1)) ** 2
            means.append(last)
            spread.append(sigma * np.sqrt(total))
        return np.array(means), np.array(spread)

    for kind, known, n in (("holdout", values[:32], 8), ("forecast", values, 5)):
        means, spread = by_hand(known, n)
        own = found[found.kind == kind]
        assert np.allclose(own.predicted, means) and np.allclose(own.upper_ci - own.predicted, 1.959963984540054 * spread)
        assert np.allclose(own.predicted - own.lower_ci, own.upper_ci - own.predicted)


def test_outlook_of_short_series(spark):
    rows = [("one", pd.Timestamp("2016-05-01").date(), 4.0, "test"), ("two", pd.Timestamp("2016-05-01").date(), 4.0, "train"), ("two", pd.Timestamp("2016-06-01").date(), 6.0, "test")]
    split = spark.createDataFrame(rows, "series_key string, month_start date, value double, part string")
    found = forecasting.model_outlook(split, 3).toPandas()
    assert found.groupby(["series_key", "kind"]).size().to_dict() == {("one", "forecast"): 3, ("one", "holdout"): 1, ("two", "forecast"): 3, ("two", "history"): 1, ("two", "holdout"): 1}
    summary = forecasting.forecast_summary(forecasting.outlook_forecast(forecasting.model_outlook(split, 3))).collect()
    assert {r.series_key: r.peak_value for r in summary} == {"one": 4, "two": 12}
    assert forecasting.model_outlook(split.limit(0), 3).count() == 0
