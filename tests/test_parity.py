"""Every query with SQL against DuckDB, and invariants of the others, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from parity import difference, duck

from stayledger.plans import oracle_book, query_book

QUERIES, SQL = query_book.queries(), oracle_book.oracle_sql()
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


IN_PYTHON = {"cancellation_holdout", "churn_holdout"}  # trees are walked batch by batch
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.fixture(scope="module")
def connection(tables_folder):
    return duck(tables_folder)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "sarima_forecast", "sarima_metrics", "cancellation_scores", "churn_scores", "feature_importance",
        "loyalty_recommendations", "churn_feature_importance", "model_form_tiers", "churn_form_tiers", "model_forecast_summary",
        *(f"{kind}_model_{table}" for kind in ("cancellation", "churn") for table in ("metrics", "report", "confusion", "roc_auc", "roc_curve")),
    }
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables_folder, connection, name):
    df = QUERIES[name](spark, tables_folder)
    types = {row[0]: row[1] for row in connection.execute("DESCRIBE " + SQL[name]).fetchall()}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan and not (node == "InArrow" and name in IN_PYTHON)]
    assert difference(df.toPandas(), connection.execute(SQL[name]).fetch_df()) is None


def test_flagship(spark):
    assert contract.entry(spark).count() == 5


def test_scores_are_probabilities(spark, tables_folder):
    for name in ("cancellation_scores", "churn_scores"):
        scores = QUERIES[name](spark, tables_folder).toPandas()
        assert scores.probability.between(0, 1).all() and set(scores.prediction) <= {0, 1}
        assert len(scores) == 1200 and scores.booking_id.is_unique


def test_importances(spark, tables_folder):
    top = QUERIES["feature_importance"](spark, tables_folder).toPandas()
    assert list(top["rank"]) == list(range(1, 21)) and 0 < top.importance.sum() <= 1 + 1e-9
    assert top.importance.is_monotonic_decreasing


def test_quality_of_the_fitted_models(spark, tables_folder):
    for kind, positive in (("cancellation", "is_canceled"), ("churn", "is_churned")):
        cells = QUERIES[f"{kind}_model_confusion"](spark, tables_folder).toPandas()
        assert cells["count"].sum() == 1200, positive
        metrics = QUERIES[f"{kind}_model_metrics"](spark, tables_folder).first().asDict()
        assert all(0 <= value <= 1 for value in metrics.values() if value is not None)
        assert 0.4 <= QUERIES[f"{kind}_model_roc_auc"](spark, tables_folder).first()[0] <= 1


def test_form_to_tier(spark, tables_folder):
    tiers = QUERIES["model_form_tiers"](spark, tables_folder).toPandas()
    assert len(tiers) == 6000 and tiers.cancellation_probability.between(0, 1).all() and tiers.actions.str.len().gt(0).all()


def test_loyalty_counts_every_booking(spark, tables_folder):
    assert QUERIES["loyalty_recommendations"](spark, tables_folder).toPandas().customer_count.sum() == 6000


def test_forecast_shape(spark, tables_folder):
    forecast = QUERIES["sarima_forecast"](spark, tables_folder).toPandas()
    assert forecast.groupby("series_key").size().eq(12).all() and len(forecast) == 120
    assert (forecast.lower_ci <= forecast.predicted_bookings).all() and (forecast.predicted_bookings <= forecast.upper_ci).all()
    for _, rows in forecast.sort_values("date").groupby("series_key"):
        assert (rows.upper_ci - rows.lower_ci).is_monotonic_increasing


def test_model_summary_and_churn_form(spark, tables_folder):
    row = QUERIES["model_forecast_summary"](spark, tables_folder).first()
    assert row.low_value <= row.average <= row.peak_value and row.total >= 12 * row.low_value
    tiers = QUERIES["churn_form_tiers"](spark, tables_folder).toPandas()
    assert len(tiers) == 6000 and tiers.churn_probability.between(0, 1).all() and tiers.strategy.notna().all()
