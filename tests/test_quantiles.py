"""Exact ranks and splits against brute force, with limits lowered so that every path is taken."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.operators import preparation, quantiles


@pytest.mark.parametrize("limit", [100_000, 50])
@pytest.mark.parametrize("shape", ["uniform", "heavy", "copies", "few"])
def test_exact_quantile(spark, monkeypatch, limit, shape):
    monkeypatch.setattr(quantiles, "MAX_RANKED_VALUES", limit)
    rng = np.random.default_rng(11)
    values = {
        "uniform": rng.uniform(0, 1, 20_001),
        "heavy": np.exp(rng.normal(0, 4, 20_000)),
        "copies": np.where(rng.uniform(size=9_000) < 1 / 3, 7.0, rng.normal(size=9_000)),
        "few": np.array([1.0, 2.0, 3.0, 4.0]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(4)
    for q in (0.0, 0.25, 0.5, 0.75, 1.0):
        assert quantiles.exact_quantile(df, "x", q) == pytest.approx(np.quantile(values, q), rel=1e-12)


def test_several_columns_at_once(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "MAX_RANKED_VALUES", 100)
    rng = np.random.default_rng(4)
    few, many = rng.integers(0, 9, 4000).astype(float), rng.normal(size=4000)
    rows = [(float(a), float(b), None, None if i % 2 else float(i % 8)) for i, (a, b) in enumerate(zip(few, many))]
    out = quantiles.exact_quantiles(spark.createDataFrame(rows, "few double, many double, none double, half double"), ["few", "many", "none", "half"], 0.75)
    expected = {"few": np.quantile(few, 0.75), "many": np.quantile(many, 0.75), "half": np.quantile(np.arange(0, 4000, 2) % 8, 0.75)}
    assert out.pop("none") is None
    assert out == pytest.approx(expected)


def test_quantile_of_nothing(spark):
    assert quantiles.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None


@pytest.mark.parametrize("small_bin", [10_000, 5])
def test_stratified_parts(spark, monkeypatch, small_bin):
    monkeypatch.setattr(preparation, "SMALL_BIN", small_bin)
    df = spark.range(1, 9001).select(F.col("id").alias("booking_id"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    shares = {"test": 0.2, "tune": 0.1, "train": 0.7}
    actual = {r.booking_id: r.part for r in preparation.stratified_parts(df, "y", shares).collect()}
    assert len(actual) == 9000
    for label in (0, 1):
        ids = sorted((i for i in range(1, 9001) if int(i % 9 == 0) == label), key=lambda i: hashlib.md5(f"{i}-42".encode()).hexdigest())
        n, tune = int(len(ids) * 0.2 + 0.5), int(len(ids) * (0.2 + 0.1) + 0.5)
        expected = {i: "test" if k < n else "tune" if k < tune else "train" for k, i in enumerate(ids)}
        assert all(actual[i] == part for i, part in expected.items())


def test_tiny_label_is_kept(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "booking_id long, y int")
    parts = preparation.stratified_parts(df, "y", {"test": 0.2, "train": 0.8})
    assert parts.filter("part IS NULL").count() == 0 and parts.count() == 3


def test_most_frequent(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("a", "y"), ("b", "y"), (None, "y")], "t string, u string")
    assert {r.column_name: r.value for r in quantiles.most_frequent(df, ["t", "u"]).collect()} == {"t": "a", "u": "y"}
