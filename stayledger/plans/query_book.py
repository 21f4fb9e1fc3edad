"""All registered queries: name -> function of (spark, folder of the order tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import buckets, risk
from ..functions.measures import total_value
from ..operators import (
    advice, cancellations, classifiers, churn, correlation, demand, display, evaluation, filters, forecasting, preparation,
    retention, revenue, seasonality, segments, tree_tables, trends,
)
from ..operators.dimensions import DIMENSIONS
from ..operators.facts import DERIVED, KEY_COLUMNS, MEASURES
from ..session import stored
from ..sources.booking_schema import RAW_COLUMNS
from ..sources.csv_bookings import read_booking_csv
from ..sources.warehouse_store import Warehouse
from . import model_flows
from .warehouse_build import csv_landing_for, warehouse_for

Query = Callable[[SparkSession, str], DataFrame]

GRID_ROWS = 300  # of each of the 36 fits of the search
SERIES_PARTS = ("hotel_name", "country", "meal_plan", "market_segment")


def _on_warehouse(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: build(warehouse_for(spark, folder))


def _on_columns(build: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    """A query over some columns of the star; only the dimensions they need are joined."""
    return lambda spark, folder: build(warehouse_for(spark, folder).star(*columns))


def _ranked(house: Warehouse, *columns: str) -> DataFrame:
    """Bookings with a score that needs no model, so results can be compared with SQL: lead time over 450 days."""
    wanted = dict.fromkeys(["booking_id", "is_canceled", "lead_time", *columns])
    return house.star(*wanted).withColumn("probability", F.col("lead_time") / 450.0)


def _predicted(house: Warehouse) -> DataFrame:
    return _ranked(house).select(
        "booking_id",
        F.col("is_canceled").alias("label"),
        F.col("probability").alias("score"),
        risk.high_risk("probability").cast("int").alias("prediction"),
    )


def _series(house: Warehouse, *parts: str) -> DataFrame:
    return model_flows.demand_series(house, parts=parts)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _churn_scored(house: Warehouse) -> DataFrame:
    return _ranked(house, "adr", "total_stay_nights").withColumnRenamed("probability", "churn_probability")


def _score_form(house: Warehouse) -> DataFrame:
    complete = classifiers.cancellation_form(house.star(*FORM_FIELDS))
    scored = complete.withColumn("cancellation_probability", F.col("lead_time") / 450.0)
    tiers = segments.risk_tiers(scored, "cancellation_probability", kind="cancellation")
    return tiers.withColumn("high_risk", risk.high_risk("cancellation_probability"))


def _score_customers(house: Warehouse) -> DataFrame:
    """Churn form over all bookings; the score stands in for a model: special requests and changes over 8."""
    asked = [
        "booking_id", "hotel_name", "customer_type", "is_repeated_guest", "previous_cancellations", "market_segment",
        "distribution_channel", "booking_changes", "room_changed", "adr", "total_of_special_requests",
        "previous_bookings_not_canceled", "deposit_type",
    ]
    complete = classifiers.churn_form(house.star(*asked))
    points = F.col("total_of_special_requests") + F.col("booking_changes")
    return segments.risk_tiers(complete.withColumn("churn_probability", points / 8.0), "churn_probability")


def _hotel_outlook(house: Warehouse) -> DataFrame:
    bookings = filters.apply_filters(house.star("year", "month", "hotel_name"), hotel="Resort Hotel")
    history = demand.monthly_series(bookings)
    return forecasting.demand_outlook(history, forecasting.baseline_forecast(history, 12))


def _trained_forest(house: Warehouse) -> model_flows.Trained:
    return _fitted(house, "forest", lambda: model_flows.train_cancellation(house))


def _trained_boosting(house: Warehouse) -> model_flows.Trained:
    return _fitted(house, "boosting", lambda: model_flows.train_churn(house))


_models: dict[tuple[str, str], model_flows.Trained] = {}
_node_tables: dict[tuple[str, str], DataFrame] = {}


def _fitted(house: Warehouse, name: str, fit: Callable[[], model_flows.Trained]) -> model_flows.Trained:
    if (house.folder, name) not in _models:
        _models[(house.folder, name)] = fit()
    return _models[(house.folder, name)]


def _importance(house: Warehouse) -> DataFrame:
    model = _trained_forest(house).model
    return classifiers.feature_importance(
        house.spark, model, classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES
    )


def _churn_importance(house: Warehouse) -> DataFrame:
    numeric, categories = classifiers.churn_features()
    return classifiers.feature_importance(house.spark, _trained_boosting(house).model, numeric, categories)


def _holdout(house: Warehouse, trained: model_flows.Trained, name: str) -> DataFrame:
    """Every booking of the test part, and whether its prediction follows from a probability between 0 and 1 which the
    table of tree nodes gives as well."""
    given = (trained.label, trained.probability, "prediction")
    scored = tree_tables.score_by_nodes(trained.score_test(), trained.model, _nodes(house, name), keep=given)
    probability = F.col(trained.probability)
    follows = probability.between(0, 1) & (F.col("prediction") == (probability > 0.5).cast("int"))
    same = F.abs(probability - F.col("by_nodes")) < 1e-9
    return scored.select("booking_id", F.col(trained.label).alias("label"), (follows & same).alias("consistent"))


def _nodes(house: Warehouse, name: str) -> DataFrame:
    """The trees of the model fitted here, not of another application's."""
    if (house.folder, name) not in _node_tables:
        trained = {"forest": _trained_forest, "boosting": _trained_boosting}[name](house)
        _node_tables[(house.folder, name)] = tree_tables.node_table(house.spark, trained.model)
    return _node_tables[(house.folder, name)]


def _importance_check(house: Warehouse, name: str, numeric: list[str], categories: list[str]) -> DataFrame:
    """Every feature of the model, and whether its importance follows from the nodes that split on it."""
    trained = {"forest": _trained_forest, "boosting": _trained_boosting}[name](house)
    rows = [(i, feature, value) for i, (feature, value) in enumerate(classifiers.importances(trained.model, numeric, categories))]
    given = house.spark.createDataFrame(rows, "place int, name string, importance double")  # one row per feature
    found = tree_tables.importance_by_nodes(_nodes(house, name), name == "forest").select(F.col("feature").alias("place"), F.col("importance").alias("by_nodes"))
    close = F.abs(F.col("importance") - F.coalesce("by_nodes", F.lit(0.0))) < 1e-9
    return given.join(found, "place", "left").select(F.col("name").alias("feature"), close.alias("consistent"))


def _grid(house: Warehouse) -> DataFrame:
    """The full search on a bounded number of labelled rows: every combination and fold with the rows it was judged on."""
    train = model_flows.cancellation_data(house).filter("part = 'train'").drop("part")
    return house.derived("grid", lambda: classifiers.grid_search(train, classifiers.FULL_GRID, parallelism=8, most_rows=GRID_ROWS))


def _quality(name: str, trained: Callable[[Warehouse], model_flows.Trained]) -> dict[str, Query]:
    """The quality tables of a fitted model on its test part."""
    return {
        f"{name}_metrics": _on_warehouse(lambda h: trained(h).metrics),
        f"{name}_report": _on_warehouse(lambda h: trained(h).report),
        f"{name}_confusion": _on_warehouse(lambda h: trained(h).confusion),
        f"{name}_roc_auc": _on_warehouse(lambda h: trained(h).roc_auc),
        f"{name}_roc_curve": _on_warehouse(lambda h: trained(h).roc_curve),
    }


FORM_FIELDS = [
    "booking_id", "hotel_name", "lead_time", "total_stay_nights", "market_segment", "distribution_channel",
    "is_repeated_guest", "deposit_type", "customer_type", "adr", "total_of_special_requests", "booking_changes",
    "required_car_parking_spaces",
]


def _model_form(house: Warehouse) -> DataFrame:
    """The fields a form asks for, completed, scored by the fitted forest, and turned into a tier with its actions."""
    complete = classifiers.cancellation_form(house.star(*FORM_FIELDS))
    scored = classifiers.score(_trained_forest(house).model, complete, "cancellation_probability")
    tiers = segments.risk_tiers(scored, "cancellation_probability", kind="cancellation")
    return tiers.select("booking_id", F.round("cancellation_probability", 6).alias("cancellation_probability"), "risk_level", "actions", "high_risk")


CHURN_FIELDS = [
    "booking_id", "hotel_name", "customer_type", "is_repeated_guest", "previous_cancellations", "market_segment",
    "distribution_channel", "booking_changes", "room_changed", "adr", "total_of_special_requests",
    "previous_bookings_not_canceled", "deposit_type",
]


def _churn_form(house: Warehouse) -> DataFrame:
    """The same for the churn form: completed, scored by the fitted boosting, with strategy and actions."""
    complete = classifiers.churn_form(house.star(*CHURN_FIELDS))
    scored = classifiers.score(_trained_boosting(house).model, complete, "churn_probability")
    tiers = segments.risk_tiers(scored, "churn_probability")
    return tiers.select("booking_id", F.round("churn_probability", 6).alias("churn_probability"), "risk_level", "strategy", "actions", "high_risk")


def _loyalty(house: Warehouse) -> DataFrame:
    """Every booking scored by the fitted boosting and put into its segment; the scores are stored once for this application."""
    if (house.folder, "loyalty") not in _node_tables:
        scored = stored(model_flows.churn_scored(house, _trained_boosting(house).model), "churn-scores")
        _node_tables[(house.folder, "loyalty")] = segments.with_risk_value_segment(scored).select("booking_id", "churn_probability", "total_value", "segment")
    return _node_tables[(house.folder, "loyalty")]


def _loyalty_check(house: Warehouse) -> DataFrame:
    """Every booking with its value, the value part of its segment, and whether the risk part is the one its score calls for."""
    parts = F.split("segment", " ")
    called_for = F.when(F.col("churn_probability") > 0.7, "High-Risk").when(F.col("churn_probability") > 0.3, "Medium-Risk").otherwise("Loyal")
    return _loyalty(house).select(
        "booking_id", F.round("total_value", 2).alias("total_value"), parts[0].alias("worth"), (parts[1] == called_for).alias("consistent")
    )


def _scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    return read_booking_csv(spark, csv_landing_for(spark, folder), extra=("booking_id",))


def _baseline(house: Warehouse) -> DataFrame:
    return forecasting.baseline_forecast(_history(house), 6)


def _history(house: Warehouse) -> DataFrame:
    return demand.monthly_series(house.star("year", "month"))


CHURN_CATEGORIES = ["hotel_name", "customer_type", "deposit_type", "market_segment", "season"]
def _model_outlook(house: Warehouse, *parts: str) -> DataFrame:
    split = demand.time_split(_series(house, *parts))
    return house.result("model_outlook", lambda: forecasting.model_outlook(split, 12), parts=list(parts))


def _widens() -> Column:
    """Whether the interval is at least as wide as that of the month before."""
    earlier = Window.partitionBy("series_key", "kind").orderBy("month_start")
    width = F.col("upper_ci") - F.col("lower_ci")
    return width >= F.coalesce(F.lag(width).over(earlier), F.lit(0.0)) - 1e-9


def _known_part(outlook: DataFrame) -> DataFrame:
    """The forecast's figures come from a fit that SQL does not repeat; whether they are in order can be told."""
    forecast = F.col("kind") == "forecast"
    ordered = (F.col("lower_ci") <= F.col("bookings")) & (F.col("bookings") <= F.col("upper_ci"))
    return outlook.select("kind", "year", "month", F.when(~forecast, F.col("bookings")).alias("bookings"), (~forecast | ordered).alias("ordered"))


STANDARDIZED = ["lead_time", "adr", "total_stay_nights", "total_guests"]


def queries() -> dict[str, Query]:
    book: dict[str, Query] = {
        # Sources and warehouse
        "scan_bookings": _scan_csv,
        "warehouse_counts": _on_warehouse(lambda h: h.row_counts()),
        **{name: _on_warehouse(lambda h, name=name: h.table(name)) for name in DIMENSIONS},
        "booking_fact": _on_warehouse(lambda h: h.table("booking_fact").select("booking_id", *MEASURES, *DERIVED)),
        "fact_keys": _on_warehouse(lambda h: h.table("booking_fact").select("booking_id", *KEY_COLUMNS)),
        # Joined views and filters
        "booking_wide": _on_columns(lambda df: df, *filters.WIDE_COLUMNS),
        "cancellation_features": _on_columns(lambda df: df, *filters.CANCELLATION_COLUMNS),
        "churn_features": _on_columns(lambda df: df, *filters.CHURN_COLUMNS),
        "filtered_bookings": _on_columns(
            lambda df: filters.apply_filters(df, "City Hotel", (1996, 1997), "BUILDING", "ASIA"), *filters.WIDE_COLUMNS
        ),
        "filter_options": _on_warehouse(
            lambda h: filters.filter_options(h.table("hotel_dim"), h.table("date_dim"), h.table("customer_dim"))
        ),
        "booking_detail": _on_warehouse(
            lambda h: filters.booking_detail(h.star("booking_id", *filters.DETAIL_COLUMNS, first=filters.DETAIL_ROWS))
        ),
        # Booking trends
        "monthly_bookings": _on_columns(trends.monthly_bookings, "year", "month"),
        "seasonal_bookings": _on_columns(trends.seasonal_bookings, "season"),
        "lead_time_distribution": _on_columns(trends.lead_time_distribution, "lead_time"),
        "stay_distribution": _on_columns(trends.stay_distribution, "total_stay_nights"),
        "lead_bucket_form": _on_columns(trends.lead_bucket_form, "lead_time"),
        "channel_distribution": _on_columns(lambda df: trends.distribution(df, "distribution_channel"), "distribution_channel"),
        "market_distribution": _on_columns(lambda df: trends.distribution(df, "market_segment"), "market_segment"),
        "top_channel": _on_columns(lambda df: trends.distribution(df, "distribution_channel").limit(1), "distribution_channel"),
        "busiest_months": _on_columns(trends.busiest_months, "month"),
        # Cancellations
        "cancellation_kpis": _on_columns(cancellations.cancellation_kpis, "is_canceled"),
        "cancel_by_lead_time": _on_columns(cancellations.cancel_by_lead_time, "lead_time", "is_canceled"),
        "cancel_by_deposit": _on_columns(lambda df: cancellations.cancel_by(df, "deposit_type"), "deposit_type", "is_canceled"),
        "cancel_by_market": _on_columns(lambda df: cancellations.cancel_by(df, "market_segment"), "market_segment", "is_canceled"),
        "cancel_trend": _on_columns(cancellations.cancel_trend, "year", "month", "is_canceled"),
        "lead_time_by_status": _on_columns(lambda df: cancellations.mean_by_status(df, "lead_time"), "lead_time", "is_canceled"),
        "requests_by_status": _on_columns(
            lambda df: cancellations.mean_by_status(df, "total_of_special_requests"), "total_of_special_requests", "is_canceled"
        ),
        "worst_lead_bucket": _on_columns(cancellations.worst_lead_bucket, "lead_time", "is_canceled"),
        "worst_market": _on_columns(lambda df: cancellations.worst(df, "market_segment"), "market_segment", "is_canceled"),
        "cancel_crosstab": _on_columns(
            lambda df: cancellations.crosstab(
                df.withColumn("lead_time_bucket", buckets.LEAD_TIME.label("lead_time")),
                ["hotel_name", "lead_time_bucket", "deposit_type", "market_segment"],
                "is_canceled",
            ),
            "hotel_name", "lead_time", "deposit_type", "market_segment", "is_canceled",
        ),
        "correlation_matrix": _on_columns(
            lambda df: correlation.correlation_matrix(df, correlation.DASHBOARD_COLUMNS), *correlation.DASHBOARD_COLUMNS
        ),
        "cancellation_correlation": _on_columns(
            lambda df: correlation.correlation_matrix(df, correlation.MODEL_COLUMNS + ["is_canceled"]),
            *correlation.MODEL_COLUMNS, "is_canceled",
        ),
        "null_profile": _on_warehouse(lambda h: cancellations.null_profile(h.table("raw_bookings").select(*RAW_COLUMNS))),
        # Revenue
        "revenue_kpis": _on_columns(revenue.revenue_kpis, "revenue", "adr", "is_canceled"),
        "kpi_texts": _on_columns(display.kpi_texts, "is_canceled", "revenue", "adr"),
        "monthly_revenue": _on_columns(revenue.monthly_revenue, "year", "month", "revenue"),
        "monthly_adr": _on_columns(revenue.monthly_adr, "year", "month", "adr"),
        "revenue_by_market": _on_columns(lambda df: revenue.revenue_by(df, "market_segment"), "market_segment", "revenue", "adr"),
        "revenue_by_room": _on_columns(lambda df: revenue.revenue_by(df, "reserved_room_type"), "reserved_room_type", "revenue", "adr"),
        "revenue_by_season": _on_columns(revenue.revenue_by_season, "season", "revenue", "adr"),
        "revenue_by_stay": _on_columns(revenue.revenue_by_stay, "total_stay_nights", "revenue", "adr"),
        "top_markets": _on_columns(revenue.top_markets, "market_segment", "revenue", "adr"),
        "seasons_by_revenue": _on_columns(revenue.seasons_by_revenue, "season", "revenue", "adr"),
        "top_rooms": _on_columns(revenue.top_rooms, "reserved_room_type", "revenue", "adr"),
        "top_stays": _on_columns(revenue.top_stays, "total_stay_nights", "revenue", "adr"),
        # Retention and operations
        "retention_kpis": _on_columns(
            retention.retention_kpis, "adr", "total_stay_nights", "is_repeated_guest", "total_of_special_requests"
        ),
        "retention_by_market": _on_columns(
            lambda df: retention.retention_by(df, "market_segment"), "market_segment", "is_repeated_guest"
        ),
        "best_retention_market": _on_columns(
            lambda df: retention.retention_by(df, "market_segment").limit(1), "market_segment", "is_repeated_guest"
        ),
        "operational_kpis": _on_columns(retention.operational_kpis, "lead_time", "total_stay_nights", "room_changed"),
        "value_segment": _on_columns(
            lambda df: retention.with_value_segment(df).select("booking_id", "total_value", "value_segment"),
            "booking_id", "adr", "total_stay_nights",
        ),
        # Churn and segments
        "customer_key": _on_columns(
            lambda df: churn.with_customer_id(df).select("booking_id", "customer_id"),
            "booking_id", "country", "adults", "children", "babies",
        ),
        "customer_rollup": _on_columns(
            lambda df: _rounded(churn.customer_rollup(churn.with_customer_id(df)), "cancel_rate", "avg_return_gap_days"),
            "country", "adults", "children", "babies", "is_canceled", "is_repeated_guest", "reservation_status_date",
        ),
        "churn_label": _on_warehouse(model_flows.churn_labels),
        "churn_summary": _on_warehouse(lambda h: churn.churn_summary(model_flows.churn_labels(h))),
        "churn_crosstab": _on_warehouse(
            lambda h: cancellations.crosstab(model_flows.labelled_bookings(h, *CHURN_CATEGORIES), CHURN_CATEGORIES, "is_churned")
        ),
        "churn_correlation": _on_warehouse(
            lambda h: correlation.correlation_matrix(
                model_flows.labelled_bookings(h, *correlation.MODEL_COLUMNS), correlation.MODEL_COLUMNS + ["is_churned"]
            )
        ),
        "risk_tiers": _on_warehouse(
            lambda h: segments.risk_tiers(_ranked(h)).select("booking_id", "probability", "risk_level", "strategy", "actions")
        ),
        "risk_value_segment": _on_warehouse(
            lambda h: segments.with_risk_value_segment(_churn_scored(h)).select("booking_id", "segment")
        ),
        "segment_recommendations": _on_warehouse(
            lambda h: segments.segment_recommendations(segments.with_risk_value_segment(_churn_scored(h)))
        ),
        "score_bookings": _on_warehouse(_score_form),
        "score_customers": _on_warehouse(_score_customers),
        # Demand series
        "monthly_demand": _on_columns(
            lambda df: _rounded(_rounded(demand.monthly_demand(df), "avg_daily_rate"), "total_revenue", digits=2),
            "year", "month", "hotel_name", "adr", "total_stay_nights",
        ),
        "total_demand": _on_columns(
            lambda df: _rounded(
                _rounded(demand.total_demand(demand.monthly_demand(df)), "avg_daily_rate", "weighted_daily_rate"),
                "total_revenue", digits=2,
            ),
            "year", "month", "hotel_name", "adr", "total_stay_nights",
        ),
        "month_grid": _on_columns(lambda df: demand.month_grid(demand.monthly_series(df, SERIES_PARTS)), "year", "month", *SERIES_PARTS),
        "month_ffill": _on_columns(
            lambda df: demand.complete_series(demand.monthly_series(df, SERIES_PARTS)), "year", "month", *SERIES_PARTS
        ),
        "seasonal_decomposition": _on_warehouse(
            lambda h: _rounded(
                seasonality.seasonal_decomposition(_series(h)), "observed", "trend", "seasonal", "resid"
            ).drop("series_key")
        ),
        "acf": _on_warehouse(lambda h: _rounded(seasonality.acf(_series(h)), "value").drop("series_key")),
        "pacf": _on_warehouse(lambda h: _rounded(seasonality.pacf(_series(h)), "value").drop("series_key")),
        "time_split": _on_warehouse(lambda h: demand.time_split(_series(h)).drop("series_key")),
        "baseline_forecast": _on_warehouse(lambda h: _baseline(h).drop("series_key")),
        "forecast_summary": _on_warehouse(lambda h: forecasting.forecast_summary(_baseline(h)).drop("series_key")),
        "demand_outlook": _on_warehouse(lambda h: forecasting.demand_outlook(_history(h), _baseline(h))),
        "hotel_outlook": _on_warehouse(_hotel_outlook),
        "forecast_metrics": _on_warehouse(
            lambda h: _rounded(
                forecasting.forecast_metrics(
                    demand.time_split(forecasting.seasonal_naive(_series(h, "hotel_name", "market_segment"))).filter("part = 'test'")
                ),
                "rmse", "mae", "r2",
            )
        ),
        "sarima_forecast": _on_warehouse(
            lambda h: forecasting.forecast_from(
                forecasting.fit_sarima(_series(h, "hotel_name", "market_segment"), (1, 1, 1), (1, 1, 1, 12)), 12
            )
        ),
        "sarima_metrics": _on_warehouse(
            lambda h: forecasting.forecast_metrics(
                forecasting.holdout_predictions(
                    demand.time_split(_series(h, "hotel_name", "market_segment")), (1, 1, 1), (1, 1, 1, 12)
                )
            )
        ),
        "model_outlook": _on_warehouse(
            lambda h: _model_outlook(h, "hotel_name", "market_segment").select(
                "series_key", "kind", "month_start", "value",
                ((F.col("kind") == "history") | (F.col("lower_ci") <= F.col("predicted")) & (F.col("predicted") <= F.col("upper_ci")) & _widens()).alias("ordered"),
            )
        ),
        "model_demand_outlook": _on_warehouse(
            lambda h: _known_part(forecasting.demand_outlook(forecasting.outlook_history(_model_outlook(h)), forecasting.outlook_forecast(_model_outlook(h))))
        ),
        "model_forecast_summary": _on_warehouse(lambda h: forecasting.forecast_summary(forecasting.outlook_forecast(_model_outlook(h))).drop("series_key")),
        # Preparation and evaluation
        "impute_numeric": _on_warehouse(
            lambda h: preparation.impute_numeric(
                h.raw_bookings().select("booking_id", "children", "agent", "company"), ["children", "agent", "company"]
            )
        ),
        "impute_category": _on_columns(
            lambda df: preparation.impute_category(df, ["country", "market_segment"]), "booking_id", "country", "market_segment"
        ),
        "stratified_split": _on_columns(
            lambda df: preparation.stratified_parts(df, "is_canceled", model_flows.TEST_SHARE)
            .groupBy("part", F.col("is_canceled").alias("label"))
            .count(),
            "booking_id", "is_canceled",
        ),
        "split_assignment": _on_columns(
            lambda df: preparation.stratified_parts(df, "is_canceled", model_flows.TEST_SHARE), "booking_id", "is_canceled"
        ),
        "standardize": _on_columns(
            lambda df: _rounded(preparation.standardize(df, STANDARDIZED), *STANDARDIZED), "booking_id", *STANDARDIZED
        ),
        "binary_metrics": _on_warehouse(lambda h: evaluation.binary_metrics(_predicted(h))),
        "classification_report": _on_warehouse(lambda h: evaluation.classification_report(_predicted(h))),
        "confusion_matrix": _on_warehouse(lambda h: evaluation.confusion_matrix(_predicted(h))),
        "roc_auc": _on_warehouse(lambda h: evaluation.roc_auc(_predicted(h))),
        "roc_points": _on_warehouse(lambda h: _rounded(evaluation.roc_curve(_predicted(h), all_points=True), "threshold")),
        "roc_curve": _on_warehouse(lambda h: _rounded(evaluation.roc_curve(_predicted(h)), "threshold")),
        # Fitted models
        "cancellation_scores": _on_warehouse(
            lambda h: _trained_forest(h).scored.select("booking_id", F.col("cancellation_probability").alias("probability"), "prediction")
        ),
        "churn_scores": _on_warehouse(
            lambda h: _trained_boosting(h).scored.select("booking_id", F.col("churn_probability").alias("probability"), "prediction")
        ),
        "cancellation_holdout": _on_warehouse(lambda h: _holdout(h, _trained_forest(h), "forest")),
        "churn_holdout": _on_warehouse(lambda h: _holdout(h, _trained_boosting(h), "boosting")),
        "cancellation_trees": _on_warehouse(lambda h: tree_tables.tree_check(_nodes(h, "forest"))),
        "churn_trees": _on_warehouse(lambda h: tree_tables.tree_check(_nodes(h, "boosting"))),
        "importance_check": _on_warehouse(
            lambda h: _importance_check(h, "forest", classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES)
        ),
        "churn_importance_check": _on_warehouse(lambda h: _importance_check(h, "boosting", *classifiers.churn_features())),
        "cancellation_grid": _on_warehouse(
            lambda h: _grid(h).select("depth", "min_leaf", "trees", "fold", "rows", F.coalesce(F.col("roc_auc").between(0.3, 1), F.lit(True)).alias("judged"))  # none in a fold of one class
        ),
        **_quality("cancellation_model", _trained_forest),
        **_quality("churn_model", _trained_boosting),
        "feature_importance": _on_warehouse(_importance),
        "churn_feature_importance": _on_warehouse(_churn_importance),
        "model_form_tiers": _on_warehouse(_model_form),
        "loyalty_total": _on_warehouse(lambda h: segments.segment_recommendations(_loyalty(h)).agg(F.sum("customer_count").alias("bookings"))),
        "loyalty_recommendations": _on_warehouse(lambda h: segments.segment_recommendations(_loyalty(h))),
        "loyalty_segments": _on_warehouse(_loyalty_check),
        "churn_form_tiers": _on_warehouse(_churn_form),
        # Advice
        "revenue_advice": _on_columns(
            advice.revenue_advice, "season", "market_segment", "reserved_room_type", "total_stay_nights", "revenue", "adr"
        ),
        "cancellation_advice": _on_columns(advice.cancellation_advice, "lead_time", "market_segment", "is_canceled"),
    }
    return book


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Cancellation rate by market segment."""
    return queries()["cancel_by_market"](spark, folder)
