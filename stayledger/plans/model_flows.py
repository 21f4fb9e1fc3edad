"""Whole model flows from the warehouse: features, split, fit, evaluation."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ..operators import classifiers, demand, evaluation, forecasting
from ..operators.churn import history_labels, with_churn_label
from ..operators.filters import CANCELLATION_COLUMNS, CHURN_COLUMNS
from ..operators.preparation import impute_category, impute_numeric, stratified_parts
from ..operators.segments import segment_recommendations, with_risk_value_segment
from ..session import stored
from ..sources.warehouse_store import Warehouse

TEST_SHARE = {"test": 0.2, "train": 0.8}


@dataclass
class Trained:
    """A fitted model with its test part, and the scores and quality tables computed from that."""

    model: PipelineModel
    test: DataFrame
    label: str
    probability: str

    def score_test(self) -> DataFrame:
        """The test part with all its columns and its scores."""
        return classifiers.score(self.model, self.test, self.probability)

    @cached_property
    def scored(self) -> DataFrame:
        """Number, label and scores of the test part, stored on first use: each quality table reads them."""
        return stored(self.score_test().select("booking_id", self.label, self.probability, "prediction", "high_risk"), "test-scores")

    @property
    def metrics(self) -> DataFrame:
        return evaluation.binary_metrics(self.scored, self.label, "prediction")

    @property
    def roc_auc(self) -> DataFrame:
        return evaluation.roc_auc(self.scored, self.label, self.probability)

    @property
    def report(self) -> DataFrame:
        return evaluation.classification_report(self.scored, self.label, "prediction")

    @property
    def confusion(self) -> DataFrame:
        return evaluation.confusion_matrix(self.scored, self.label, "prediction")

    @property
    def roc_curve(self) -> DataFrame:
        return evaluation.roc_curve(self.scored, self.label, self.probability)


def filled(data: DataFrame, numeric: list[str], categories: list[str]) -> DataFrame:
    """Missing numbers replaced by their column's median, missing texts by the most frequent one."""
    return impute_category(impute_numeric(data, numeric), categories)


def cancellation_data(house: Warehouse) -> DataFrame:
    """Features without gaps, and the part each booking belongs to. Written once, as a fit passes over them many
    times."""

    def build() -> DataFrame:
        data = filled(house.star(*CANCELLATION_COLUMNS), classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES)
        return stratified_parts(data, "is_canceled", TEST_SHARE)

    return house.derived("cancellation_data", build)


LABEL_COLUMNS = [
    "booking_id", "country", "adults", "children", "babies", "is_canceled", "is_repeated_guest", "reservation_status_date",
    "booking_changes", "room_changed",
]


def customer_labels(house: Warehouse) -> DataFrame:
    """What the history of each customer says, one row per customer."""
    return house.derived("customer_labels", lambda: history_labels(house.star(*LABEL_COLUMNS)))


def churn_labels(house: Warehouse) -> DataFrame:
    """booking_id, customer_id and is_churned of every booking, from the columns that decide it."""

    def build() -> DataFrame:
        return with_churn_label(house.star(*LABEL_COLUMNS), customer_labels(house)).select("booking_id", "customer_id", "is_churned")

    return house.derived("churn_labels", build)


def labelled_bookings(house: Warehouse, *columns: str) -> DataFrame:
    """Columns of the star with the churn label of each booking. The history comes from the table of customers, which is
    smaller than that of bookings, and the rest of the label from the booking's own columns."""
    wanted = dict.fromkeys(["booking_id", *columns])
    labelled = with_churn_label(house.star(*dict.fromkeys([*wanted, *LABEL_COLUMNS])), customer_labels(house))
    return labelled.select(*wanted, "customer_id", "is_churned")


def churn_data(house: Warehouse) -> DataFrame:
    """Churn features without gaps, and the part each booking belongs to."""

    def build() -> DataFrame:
        data = filled(labelled_bookings(house, *CHURN_COLUMNS), classifiers.CHURN_NUMERIC, classifiers.CHURN_CATEGORIES)
        return stratified_parts(data, "is_churned", TEST_SHARE)

    return house.derived("churn_data", build)


def train_cancellation(house: Warehouse, **options) -> Trained:
    data = cancellation_data(house)
    train, test = data.filter("part = 'train'").drop("part"), data.filter("part = 'test'").drop("part")
    return Trained(classifiers.fit_cancellation(train, **options), test, "is_canceled", "cancellation_probability")


def train_churn(house: Warehouse, **options) -> Trained:
    data = churn_data(house)
    train, test = data.filter("part = 'train'").drop("part"), data.filter("part = 'test'").drop("part")
    return Trained(classifiers.fit_churn(train, **options), test, "is_churned", "churn_probability")


def churn_scored(house: Warehouse, model: PipelineModel) -> DataFrame:
    """booking_id, churn_probability and the two columns a booking's value is made of, for every booking of both parts."""
    return classifiers.score(model, churn_data(house), "churn_probability").select("booking_id", "churn_probability", "adr", "total_stay_nights")


def loyalty_segments(scored: DataFrame) -> DataFrame:
    """booking_id and its segment by risk and value, of bookings scored by :func:`churn_scored`."""
    return with_risk_value_segment(scored).select("booking_id", "segment")


def loyalty_recommendations(house: Warehouse, model: PipelineModel) -> DataFrame:
    """Score every booking for churn, segment by risk and value, and attach recommendations."""
    scored = stored(churn_scored(house, model), "churn-scores")  # the value quantile and the segments both read it
    return segment_recommendations(with_risk_value_segment(scored))


def demand_series(house: Warehouse, hotel: str | None = None, parts: tuple[str, ...] = ()) -> DataFrame:
    """Gap-free monthly booking counts: all hotels together, one hotel, or one series per combination of ``parts``."""
    bookings = house.star(*dict.fromkeys(["year", "month", "hotel_name", *parts]))
    if hotel is not None:
        bookings = bookings.filter(F.col("hotel_name") == hotel)
    return demand.complete_series(demand.monthly_series(bookings, parts))


def forecast_demand(
    house: Warehouse, hotel: str | None = None, parts: tuple[str, ...] = (), periods: int = 12,
    order: tuple[int, int, int] = (1, 1, 1), seasonal: tuple[int, int, int, int] = (1, 1, 1, 12),
) -> tuple[DataFrame, DataFrame]:
    """Hold-out metrics on the last fifth of each series, and the forecast of a fit on the full series."""
    series = demand_series(house, hotel, parts)
    held_out = forecasting.holdout_predictions(demand.time_split(series), order, seasonal)
    return forecasting.forecast_metrics(held_out), forecasting.forecast_from(forecasting.fit_sarima(series, order, seasonal), periods)
