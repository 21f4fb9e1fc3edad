"""Borders and odd rows of expressions, buckets, risk tiers, correlation, imputation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayledger.functions import buckets, calendar, measures, risk
from stayledger.operators import advice, cancellations, preparation, revenue, segments, trends
from stayledger.operators.churn import churn_summary, customer_label, customer_rollup, with_churn_label, with_customer_id
from stayledger.operators.correlation import correlation_matrix
from stayledger.operators.retention import retention_kpis, with_value_segment


def column(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def labels(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_lead_bucket_borders(spark):
    df = column(spark, [0, 1, 7, 8, 30, 31, 90, 91, 180, 181, 365, 366, None]).coalesce(1)
    assert labels(df, buckets.LEAD_TIME.label("x")) == [
        None, "0-7 days", "0-7 days", "8-30 days", "8-30 days", "31-90 days", "31-90 days", "91-180 days", "91-180 days",
        "181-365 days", "181-365 days", "366+ days", None,
    ]
    assert labels(df, buckets.LEAD_TIME.label_from_zero("x"))[0] == "0-7 days"


def test_stay_bucket_borders(spark):
    df = column(spark, [0, 1, 2, 3, 4, 5, 6, 7, 8, 14, 15]).coalesce(1)
    assert labels(df, buckets.STAY.label("x")) == [
        None, "0-1 nights", "2 nights", "3 nights", "4-5 nights", "4-5 nights", "6-7 nights", "6-7 nights", "8-14 nights",
        "8-14 nights", "15+ nights",
    ]


def test_empty_bucket_is_present(spark):
    df = spark.createDataFrame([(10, 1), (20, 0), (0, 1)], "lead_time long, is_canceled int")
    rates = {r.lead_time_bucket: r for r in cancellations.cancel_by_lead_time(df).collect()}
    assert len(rates) == 6 and rates["366+ days"]["count"] == 0 and rates["366+ days"].cancellation_rate is None
    assert rates["8-30 days"]["count"] == 2 and rates["8-30 days"].cancellation_rate == 50.0
    assert cancellations.worst_lead_bucket(df).first().lead_time_bucket == "8-30 days"


def test_buckets_and_null_bucket_add_up(house):
    df = house.star("lead_time")
    assert trends.lead_time_distribution(df).agg(F.sum("count")).first()[0] + df.filter("lead_time = 0").count() == 6000


def test_null_group_is_left_out(spark):
    df = spark.createDataFrame([("a", 1), (None, 0)], "market_segment string, is_canceled int")
    assert [r.market_segment for r in cancellations.cancel_by(df, "market_segment").collect()] == ["a"]


def test_calendar(spark):
    df = spark.createDataFrame(
        [(2015, "July", 1), (2016, "February", 30), (2016, "Smarch", 3)], "y long, m string, d long"
    ).coalesce(1)
    out = df.select(
        calendar.arrival_date("y", "m", "d").alias("date"), calendar.month_number("m").alias("n"),
        calendar.year_month("y", "m").alias("label"), calendar.month_start("y", "m").alias("start"), calendar.season("m").alias("s"),
    ).collect()
    assert [str(r.date) for r in out] == ["2015-07-01", "None", "None"]
    assert [r.n for r in out] == [7, 2, None] and out[0].label == "2015-July" and str(out[0].start) == "2015-07-01"
    assert [r.s for r in out] == ["Summer", "Winter", "Fall"]
    week = spark.sql("SELECT explode(sequence(DATE'2016-07-01', DATE'2016-07-04')) AS d").coalesce(1)
    assert labels(week, calendar.is_weekend("d")) == [False, True, True, False]
    assert labels(week.limit(1), calendar.month_title("d")) == ["July 2016"]
    order = spark.createDataFrame([("Winter",), ("Spring",), ("Summer",), ("Fall",), ("None",)], "s string").coalesce(1)
    assert labels(order, calendar.season_order("s")) == [0, 1, 2, 3, None]


def test_number_texts(spark):
    df = spark.createDataFrame([(1234567.891, 3.25)], "a double, b double")
    row = df.select(
        measures.dollars("a", 0), measures.dollars("a"), measures.percent_text("b"), measures.signed_percent_text("b")
    ).first()
    assert tuple(row) == ("$1,234,568", "$1,234,567.89", "3.2%", "+3.2%")


def test_customer_id(spark):
    df = spark.createDataFrame([(None, 2, 0.0, 0), ("PRT", 1, None, 2)], "country string, adults long, children double, babies long").coalesce(1)
    assert labels(df, measures.customer_id()) == ["nan_2_0.0_0", "PRT_1_nan_2"]


def test_risk_borders(spark):
    df = column(spark, [0.29, 0.3, 0.69, 0.7, None], "double").coalesce(1)
    assert labels(df, risk.risk_level("x")) == ["Low", "Medium", "Medium", "High", None]
    valued = df.withColumn("v", F.lit(5.0))
    assert labels(valued, risk.risk_value_segment("x", "v", 5.0))[:4] == [
        "Low-Value Loyal", "Low-Value Loyal", "Low-Value Medium-Risk", "Low-Value Medium-Risk"
    ]
    assert labels(valued, risk.value_segment("v", 5.0))[0] == "High Value"
    assert labels(column(spark, [0.5, 0.51], "double").coalesce(1), risk.high_risk("x")) == [False, True]


def test_segment_texts(spark):
    df = spark.createDataFrame([("High-Value Loyal",)], "segment string")
    row = segments.segment_recommendations(df).first()
    assert row.recommendations == "Implement recognition programs, Offer premium loyalty benefits, Create exclusive experiences"


def history(spark, *rows):
    names = "booking_id long, country string, adults long, children double, babies long, is_canceled int, is_repeated_guest int, booking_changes long, room_changed boolean, total_of_special_requests long, reservation_status_date date"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], names.replace("date date", "date string"))
    return df.withColumn("reservation_status_date", F.to_date("reservation_status_date"))


def guest(adults, day, canceled=0, repeat=0, changes=0, moved=False):
    return ("PRT", adults, 0.0, 0, canceled, repeat, changes, moved, 0, day)


def test_churn_rules(spark):
    df = history(
        spark,
        guest(1, "2016-01-01"), guest(1, "2016-01-11"),  # 10 days apart, silent for 15: exactly 1.5 x
        guest(2, "2015-12-31"), guest(2, "2016-01-10"),  # silent for 16
        guest(3, "2010-01-01", repeat=1), guest(3, "2010-01-02"), guest(3, "2010-01-03"),  # repeat guest, long silence
        guest(4, "2016-01-01", canceled=1),
        guest(5, "2016-01-01"),
        guest(6, "2016-01-01", changes=1, moved=True),
        guest(7, "2016-01-26", changes=1),  # sets the last day
    )
    labelled = {r.booking_id: r.is_churned for r in with_churn_label(df).collect()}
    assert labelled == {0: 0, 1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0, 9: 1, 10: 0}
    rollup = {r.customer_id: r for r in customer_label(customer_rollup(with_customer_id(df))).collect()}
    assert rollup["PRT_4_0.0_0"].avg_return_gap_days is None and rollup["PRT_4_0.0_0"].history_label is None
    assert rollup["PRT_1_0.0_0"].avg_return_gap_days == 10 and rollup["PRT_1_0.0_0"].days_since_last_booking == 15
    summary = churn_summary(with_churn_label(df)).first()
    assert (summary.churned, summary.not_churned) == (4, 7)


def test_hot_customer_keeps_balanced_and_equal(spark):
    """One customer holds a third of all rows; every row is labelled and none is lost."""
    rows = spark.range(0, 3000).select(
        F.col("id").alias("booking_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("customer_id"),
    )
    from stayledger.operators.skew import left_join_on_counted_key

    members = rows.groupBy("customer_id").agg(F.count("*").alias("bookings"), (F.min("booking_id") % 2).alias("label"))
    joined = left_join_on_counted_key(rows, members, "customer_id", "bookings", "label")
    plain = rows.join(members, "customer_id", "left").select("booking_id", "label")
    assert joined.count() == 3000
    assert joined.select("booking_id", "label").exceptAll(plain).count() == 0


def test_correlation_with_nulls_and_constant(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e6, 1, 500)
    b = a * 0.3 + rng.normal(0, 1, 500)
    c = np.where(np.arange(500) % 7 == 0, np.nan, b * b)
    rows = [(float(x), float(y), None if np.isnan(z) else float(z), 5) for x, y, z in zip(a, b, c)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k int")
    out = correlation_matrix(df, ["a", "b", "c", "k"]).toPandas().set_index(["col_a", "col_b"]).r
    import pandas as pd

    expected = pd.DataFrame({"a": a, "b": b, "c": c}).corr()
    for x in "abc":
        for y in "abc":
            assert out[x, y] == pytest.approx(expected.loc[x, y], abs=2e-6) and out[x, y] == out[y, x]
    assert out.loc["k"].isna().all()


def test_crosstab_counts_each_category(house):
    df = house.star("hotel_name", "deposit_type", "is_canceled")
    table = cancellations.crosstab(df, ["hotel_name", "deposit_type"], "is_canceled").toPandas()
    assert table.groupby("dimension")["count"].sum().to_dict() == {"hotel_name": 6000, "deposit_type": 6000}


def test_mode_median_and_scaling(spark):
    texts = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "t string")
    assert preparation.impute_category(texts, ["t"]).filter("t = 'a'").count() == 3
    numbers = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "n double").coalesce(1)
    assert labels(preparation.impute_numeric(numbers, ["n"]), F.col("n"))[-1] == 2.5
    scaled = preparation.standardize(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, k double").coalesce(1), ["x", "k"])
    x = np.array(labels(scaled, F.col("x")))
    assert x.mean() == pytest.approx(0) and x.std() == pytest.approx(1) and labels(scaled, F.col("k")) == [0.0, 0.0, 0.0]


def test_median_of_whole_numbers_is_not_cut(spark):
    df = spark.createDataFrame([(3, True), (4, True), (None, None)], "n int, b boolean").coalesce(1)
    filled = preparation.impute_numeric(df, ["n", "b"]).collect()
    assert sorted(r.n for r in filled) == [3.0, 3.5, 4.0] and [r.b for r in filled] == [1.0] * 3


def test_rows_without_label_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "booking_id long, y int")
    with pytest.raises(ValueError, match="1 rows have no y"):
        preparation.stratified_parts(df, "y", {"test": 0.5, "train": 0.5})


def test_rankings_compare_before_rounding(spark):
    rows = spark.range(20_000_000).select(F.lit("a").alias("market_segment"), F.lit(0).alias("is_canceled"))
    rows = rows.unionAll(spark.range(300_000_000).select(F.lit("b"), (F.col("id") == 7).cast("int")))
    assert cancellations.worst(rows, "market_segment").first().market_segment == "b"


def test_value_border_belongs_to_high(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1), (3.0, 1), (3.0, 1)], "adr double, total_stay_nights long")
    assert with_value_segment(df).filter("value_segment = 'High Value'").count() == 3


def test_figures_of_an_empty_selection(spark):
    empty = spark.createDataFrame([], "adr double, total_stay_nights long, is_repeated_guest int, total_of_special_requests long")
    row = retention_kpis(empty.withColumn("revenue", F.col("adr"))).first()
    assert row.high_value_repeat_rate == 0.0 and row.spend_diff_pct == 0.0 and row.repeat_rate is None
    kpis = cancellations.cancellation_kpis(spark.createDataFrame([], "is_canceled int")).first()
    assert (kpis.total_bookings, kpis.cancelled_bookings, kpis.confirmed_bookings) == (0, 0, 0)
    assert revenue.top_markets(spark.createDataFrame([], "market_segment string, revenue double, adr double")).count() == 0


def test_correlations_of_patterns_of_gaps(spark, capsys):
    """Pairwise complete with large means and many patterns of missing values, from one scan."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(400, 5)) + [1e9, 0, -1e6, 3, 5], columns=list("abcde"))
    frame["d"] = frame["b"] * 2 + 1
    frame["k"] = 7.1
    for c in "abd":
        frame.loc[rng.uniform(size=400) < 0.3, c] = np.nan
    frame["never"] = np.nan
    frame.loc[frame["a"].isna(), "c"] = 0.3  # constant wherever the other is missing only
    rows = [tuple(None if v != v else float(v) for v in row) for row in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns)).repartition(5)
    found = correlation_matrix(df, list(frame.columns))
    expected = frame.corr().round(6)
    table = found.toPandas().set_index(["col_a", "col_b"]).r
    assert len(table) == 49
    for a in frame.columns:
        for b in frame.columns:
            known, right = table[a, b], expected.loc[a, b]
            assert (known != known and right != right) or abs(known - right) < 2e-6 or "k" in (a, b) and known != known, (a, b, known, right)


def test_advice_on_ties_and_empty_tables(spark):
    schema = "season string, market_segment string, reserved_room_type string, total_stay_nights long, revenue double, adr double"
    rows = [("Winter", "b", "X", 1, 10.0, 5.0), ("Fall", "a", "Y", 2, 10.0, 5.0), (None, None, None, 0, 99.0, 99.0)]
    df = spark.createDataFrame(rows, schema)
    details = [r.detail for r in advice.revenue_advice(df).collect()]
    assert any("Fall" in d for d in details) and any("Target a " in d for d in details) and any("Room X" in d for d in details) and any("0-1 nights" in d for d in details)
    assert len(details) == 5 and advice.revenue_advice(df.limit(0)).collect() == []
    plan = advice.revenue_advice(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
