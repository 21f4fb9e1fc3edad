"""Evaluation figures against brute force, features, fits, stored models."""

import duckdb
import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayledger.operators import classifiers, evaluation, preparation, tree_tables
from stayledger.operators.preparation import row_hash
from stayledger.plans import model_flows, query_book


@pytest.fixture(scope="module")
def predictions(spark):
    rng = np.random.default_rng(2)
    score = np.round(rng.uniform(size=3000), 2)
    label = (rng.uniform(size=3000) < score).astype(int)
    rows = [(int(l), float(s), int(s > 0.5)) for l, s in zip(label, score)]
    return spark.createDataFrame(rows, "label int, score double, prediction int").repartition(4), label, score


def test_auc_equals_brute_force_and_trapezoid(spark, predictions):
    df, label, score = predictions
    pos, neg = score[label == 1], score[label == 0]
    brute = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert evaluation.roc_auc(df).first().roc_auc == pytest.approx(brute, abs=1e-6)
    curve = evaluation.roc_curve(df).toPandas().sort_values("threshold", ascending=False)
    assert (curve.fpr.iloc[0], curve.tpr.iloc[0]) == (0, 0) and (curve.fpr.iloc[-1], curve.tpr.iloc[-1]) == (1, 1)
    assert curve.fpr.is_monotonic_increasing and curve.tpr.is_monotonic_increasing
    assert np.trapezoid(curve.tpr, curve.fpr) == pytest.approx(brute, abs=1e-5)


def test_curve_over_many_partitions(spark, predictions):
    df, label, _ = predictions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert evaluation.roc_auc(df).first().roc_auc > 0.7
        curve = evaluation.roc_curve(df)
        assert curve.agg(F.max("tpr"), F.max("fpr")).first()[:] == (1.0, 1.0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def reduced(label, score):
    """The points that stay, by second differences of the counts along falling scores."""
    values = np.unique(score)[::-1]
    upto = np.array([[(label[score >= v] == 1).sum(), (label[score >= v] == 0).sum()] for v in values])
    keep = np.ones(len(values), bool)
    if len(values) > 2:
        keep[1:-1] = (np.diff(upto, 2, axis=0) != 0).any(axis=1)
    return values[keep], upto[keep] / upto[-1]


def test_collinear_points_go(spark, predictions):
    df, label, score = predictions
    steps = np.concatenate([np.repeat(np.arange(20) / 20, 2), [0.5, 0.96, 0.97, 0.98, 0.99]])
    tags = np.concatenate([np.tile([0, 1], 20), [1, 1, 1, 0, 0]])
    small = spark.createDataFrame([(int(l), float(s)) for l, s in zip(tags, steps)], "label int, score double").repartition(7)
    for frame, labels, scores in ((df, label, score), (small, tags, steps), (small.filter("score > 0.97"), tags[-2:], steps[-2:])):
        if (labels == 1).any():
            values, rates = reduced(labels, scores)
            for coalesce in ("true", "false"):
                spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
                found = evaluation.roc_curve(frame).toPandas().sort_values("threshold", ascending=False).iloc[1:]
                spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
                assert np.allclose(found.threshold, values) and np.allclose(found[["tpr", "fpr"]], rates, atol=1e-6)
    assert evaluation.roc_curve(small, all_points=True).count() == len(np.unique(steps)) + 1
    assert evaluation.roc_curve(small).count() < len(np.unique(steps))


def test_metrics(predictions):
    df, label, score = predictions
    predicted = (score > 0.5).astype(int)
    hit = ((label == 1) & (predicted == 1)).sum()
    row = evaluation.binary_metrics(df).first()
    assert row.accuracy == pytest.approx((label == predicted).mean(), abs=1e-6)
    assert row.precision == pytest.approx(hit / predicted.sum(), abs=1e-6) and row.recall == pytest.approx(hit / label.sum(), abs=1e-6)
    report = evaluation.classification_report(df).toPandas().set_index("class")
    assert report.loc["1", "f1"] == row.f1 and report.loc["accuracy", "f1"] == row.accuracy
    assert report.loc["0", "support"] + report.loc["1", "support"] == 3000
    assert evaluation.confusion_matrix(df).agg(F.sum("count")).first()[0] == 3000


def test_nothing_predicted_positive(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = evaluation.binary_metrics(df).first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 0.5)
    assert evaluation.confusion_matrix(df).count() == 4


def test_unseen_category_is_all_zero(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "c string, n double")
    model = Pipeline(stages=classifiers._feature_stages(["n"], ["c"])).fit(train)
    seen = model.transform(spark.createDataFrame([("zz", 2.0), (None, 2.0), ("a", 2.0)], "c string, n double").coalesce(1)).collect()
    assert [list(r.c_onehot.toArray()) for r in seen[:2]] == [[0, 0, 0], [0, 0, 0]] and seen[2].c_onehot.toArray().sum() == 1


def test_forms_supply_every_feature(house):
    asked = house.star("booking_id", "hotel_name", "lead_time", "total_stay_nights", "market_segment", "distribution_channel",
                       "is_repeated_guest", "deposit_type", "customer_type", "adr", "total_of_special_requests", "booking_changes")
    complete = classifiers.cancellation_form(asked)
    assert set(classifiers.CANCELLATION_NUMERIC + classifiers.CANCELLATION_CATEGORIES) <= set(complete.columns)
    row = complete.filter("total_stay_nights = 7").first()
    assert (row.stays_in_weekend_nights, row.stays_in_week_nights, row.revenue) == (2, 5, row.adr * 7)
    churn = classifiers.churn_form(house.star("hotel_name", "adr", "market_segment", "distribution_channel", "is_repeated_guest",
                                              "total_of_special_requests", "booking_changes", "customer_type", "deposit_type"))
    numeric, categories = classifiers.churn_features(with_leaking=True)
    assert set(numeric + categories) <= set(churn.columns)


@pytest.fixture(scope="module")
def churn_model(house):
    return model_flows.train_churn(house, rounds=3, depth=3, with_leaking=True)


def test_saved_model_scores_the_same(spark, house, churn_model, tmp_path):
    path = str(tmp_path / "model")
    classifiers.save_model(churn_model.model, path)
    data = model_flows.churn_data(house).limit(200)
    before = classifiers.score(churn_model.model, data, "p").select("booking_id", "p")
    after = classifiers.score(classifiers.load_model(path), data, "p").select("booking_id", "p")
    assert before.exceptAll(after).count() == 0
    assert {"high_risk", "prediction"} <= set(classifiers.score(churn_model.model, data, "p").columns)


def test_quality_tables(churn_model):
    metrics, auc = churn_model.metrics.first(), churn_model.roc_auc.first().roc_auc
    assert 0 <= auc <= 1 and 0 <= metrics.accuracy <= 1
    assert churn_model.report.count() == 5 and churn_model.confusion.agg(F.sum("count")).first()[0] == 1200
    assert churn_model.roc_curve.count() > 2


def test_leaked_label_is_found(house):
    data = model_flows.cancellation_data(house).withColumn("lead_time", F.col("is_canceled") * 100 + F.col("lead_time") % 7)
    model = classifiers.fit_cancellation(data.drop("part"), trees=5, depth=5)
    scored = classifiers.score(model, data, "p")
    assert evaluation.roc_auc(scored, "is_canceled", "p").first().roc_auc > 0.99
    top = classifiers.feature_importance(house.spark, model, classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES).toPandas()
    assert "lead_time" in list(top.feature[:2])


def test_grid_search(house):
    train = model_flows.cancellation_data(house).filter("booking_id % 4 = 0").drop("part")
    grid = {"trees": [2, 4], "depth": [3, 2], "min_leaf": [1]}
    results = classifiers.grid_search(train, grid, parallelism=2).toPandas()
    assert len(results) == 12 and results.roc_auc.between(0.3, 1).all()
    assert results.groupby("fold").rows.first().sum() == train.count() and results.groupby("fold").rows.nunique().eq(1).all()
    means = results.groupby(["place", "depth", "min_leaf", "trees"]).roc_auc.mean().round(6).reset_index()
    best = means.sort_values(["roc_auc", "place"], ascending=[False, True]).iloc[0]
    model = classifiers.fit_cancellation(train, grid=grid, parallelism=2).stages[-1]
    assert model.getNumTrees in (2, 4) and max(tree.depth for tree in model.trees) <= 3
    chosen = classifiers.best_combination(house.spark.createDataFrame(results))
    assert (chosen["depth"], chosen["trees"]) == (best.depth, best.trees)
    assert {k: len(v) for k, v in classifiers.FULL_GRID.items()} == {"trees": 2, "depth": 3, "min_leaf": 2}


def test_a_small_search_has_both_classes(house):
    """The smallest hashes of all are of one class here, as behind the border of a stratified part."""
    rows = model_flows.cancellation_data(house).drop("part")
    train = rows.filter((F.col("is_canceled") == 0) | (row_hash("booking_id", 42) >= "4"))
    assert [r.is_canceled for r in classifiers.bounded(train, 30).select("is_canceled").distinct().collect()] == [0]
    grid = {"trees": [2], "depth": [2], "min_leaf": [1]}
    results = classifiers.grid_search(train, grid, parallelism=3, most_rows=30).collect()
    assert sorted(r.rows for r in results) == [10, 10, 10] and all(r.roc_auc is not None for r in results)
    alone = classifiers.grid_search(train.filter("is_canceled = 0"), grid, parallelism=3, most_rows=30).collect()
    assert [(r.rows, r.roc_auc) for r in alone] == [(10, None)] * 3


def test_best_combination_takes_the_first_on_a_tie(spark):
    rows = [(0, 30, 1, 100, 0, 5, 0.5), (0, 30, 1, 100, 1, 5, 0.7), (1, 30, 1, 200, 0, 5, 0.6), (1, 30, 1, 200, 1, 5, 0.6), (2, 10, 1, 100, 0, 5, 0.59)]
    results = spark.createDataFrame(rows, "place int, depth int, min_leaf int, trees int, fold int, rows long, roc_auc double")
    assert classifiers.best_combination(results)["place"] == 0


def test_samples_are_dealt_out(house):
    """A bounded sample is read by several tasks, and two fits on it give the same trees."""
    train = model_flows.cancellation_data(house).filter("part = 'train'").drop("part")
    rows = classifiers.training_rows(train, "is_canceled", ["lead_time"], ["hotel_name"], 1000)
    assert rows.count() == 1000 and rows.agg(F.count_distinct("booking_id")).first()[0] == 1000
    dealt = classifiers._dealt(rows, 1000, 250, "booking_id")
    assert dealt.rdd.getNumPartitions() == 4
    one, two = (classifiers.fit_cancellation(train, trees=3, depth=6, most_rows=1000).stages[-1].toDebugString.split("\n", 1)[1] for _ in range(2))
    assert one == two


RECURSIVE = """
WITH RECURSIVE walk AS (
  SELECT s.row_id, s.features, n.* FROM s, n WHERE n.node = 0
  UNION ALL
  SELECT w.row_id, w.features, n.* FROM walk w JOIN n ON n.tree = w.tree AND n.node =
    CASE WHEN coalesce(w.features[w.feature + 1] <= w.threshold, list_contains(w.left_categories, w.features[w.feature + 1])) THEN w."left" ELSE w."right" END
  WHERE w.feature IS NOT NULL)
SELECT row_id, {combined} AS p FROM walk WHERE feature IS NULL GROUP BY row_id"""


@pytest.mark.parametrize("one_hot", [True, False])
@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_node_table_in_sql(spark, house, tmp_path, kind, one_hot):
    """Scores by a recursive query over the exported nodes, outside Spark, and importances from their gains."""
    if kind == "forest":
        data = model_flows.cancellation_data(house).drop("part")
        model = classifiers.fit_cancellation(data, trees=7, depth=6, one_hot=one_hot)
        names = (classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES)
    else:
        data = model_flows.churn_data(house).drop("part")
        model = classifiers.fit_churn(data, rounds=6, depth=4, one_hot=one_hot)
        names = classifiers.churn_features()
    nodes, some = tree_tables.node_table(spark, model), data.filter("booking_id % 20 = 0")
    scored = classifiers.score(model, some, "p").select("booking_id", "p").toPandas().set_index("booking_id").p
    by_nodes = tree_tables.score_by_nodes(some, model, nodes).toPandas().set_index("booking_id").by_nodes
    assert np.allclose(by_nodes.loc[scored.index], scored, atol=1e-12)
    vectors = PipelineModel(stages=model.stages[:-1]).transform(some)
    con = duckdb.connect()
    vectors.select(F.col("booking_id").alias("row_id"), vector_to_array("features").alias("features")).write.parquet(f"{tmp_path}/s")
    nodes.write.parquet(f"{tmp_path}/n")
    for name in "sn":
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}/*.parquet')")
    combined = "avg(value)" if kind == "forest" else "1 / (1 + exp(-2 * sum(value * tree_weight)))"
    in_sql = con.execute(RECURSIVE.format(combined=combined)).fetch_df().set_index("row_id").p
    assert np.allclose(in_sql.loc[scored.index], scored, atol=1e-9)
    assert tree_tables.tree_check(nodes).filter("sound").count() == nodes.select("tree").distinct().count()
    given = [value for _, value in classifiers.importances(model, *names)]
    found = {r.feature: r.importance for r in tree_tables.importance_by_nodes(nodes, kind == "forest").collect()}
    assert given == pytest.approx([found.get(i, 0.0) for i in range(len(given))], abs=1e-12)


def test_a_large_forest_is_sent_in_parts(spark, house, monkeypatch):
    data = model_flows.cancellation_data(house).drop("part").filter("booking_id % 5 = 0")
    model = classifiers.fit_cancellation(data, trees=5, depth=5)
    nodes = tree_tables.node_table(spark, model)
    monkeypatch.setattr(tree_tables, "NODES_SENT", 2 * nodes.count() // 5)
    sent = []
    arrays = tree_tables._tree_arrays
    monkeypatch.setattr(tree_tables, "_tree_arrays", lambda part: sent.append(part.count()) or arrays(part))
    found = tree_tables.score_by_nodes(classifiers.score(model, data, "p"), model, nodes, keep=("p",))
    assert found.columns == ["booking_id", "p", "by_nodes"] and found.count() == data.count()
    assert found.filter(F.abs(F.col("p") - F.col("by_nodes")) > 1e-12).count() == 0
    assert len(sent) > 1 and sum(sent) == nodes.count() and max(sent) < nodes.count()


def test_broken_trees_are_found(spark, house):
    data = model_flows.cancellation_data(house).drop("part")
    nodes = tree_tables.node_table(spark, classifiers.fit_cancellation(data, trees=3, depth=3))
    broken = nodes.filter("NOT (tree = 1 AND node = 2)").withColumn("gain", F.when(F.col("tree") != 2, F.col("gain")).otherwise(-F.col("gain")))
    assert {r.tree: r.sound for r in tree_tables.tree_check(broken).collect()} == {0: True, 1: False, 2: False}


def test_categories_as_single_columns(house):
    """The compact encoding trains on one column per category and names importances by column."""
    data = model_flows.cancellation_data(house).withColumn("deposit_type", F.when(F.col("is_canceled") == 1, "x").otherwise("y"))
    model = classifiers.fit_cancellation(data.drop("part"), trees=5, depth=3, one_hot=False)
    scored = classifiers.score(model, data, "p")
    assert evaluation.roc_auc(scored, "is_canceled", "p").first().roc_auc > 0.99
    top = classifiers.feature_importance(house.spark, model, classifiers.CANCELLATION_NUMERIC, classifiers.CANCELLATION_CATEGORIES).toPandas()
    assert top.feature[0] == "deposit_type"
    unseen = data.limit(5).withColumn("deposit_type", F.lit("never seen"))
    assert classifiers.score(model, unseen, "p").count() == 5


def test_bookings_stay_where_they_are_for_their_labels(house):
    house.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        plan = model_flows.labelled_bookings(house, "adr")._jdf.queryExecution().executedPlan().toString()
    finally:
        house.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    labels = {r.booking_id: r.is_churned for r in model_flows.churn_labels(house).collect()}
    found = model_flows.labelled_bookings(house, "adr").collect()
    assert len(found) == len(labels) and all(r.is_churned == labels[r.booking_id] for r in found)


def test_only_columns_with_gaps_are_ranked(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(preparation, "exact_quantiles", lambda df, columns, q: asked.append(list(columns)) or {c: 1.0 for c in columns})
    df = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "a int, b double, t string")
    assert [tuple(r) for r in preparation.impute_numeric(df, ["a", "b"]).orderBy("a").collect()] == [(1.0, 2.0, "x"), (2.0, 1.0, "y")]
    assert asked == [["b"]]


def test_the_test_part_is_scored_when_asked_for(house):
    trained = model_flows.train_cancellation(house, trees=2, depth=2, most_rows=300)
    assert "scored" not in vars(trained)
    assert trained.scored.count() == trained.test.count() and trained.scored.columns[0] == "booking_id"


@pytest.mark.parametrize("fit, trained", [("train_churn", "_trained_boosting"), ("train_cancellation", "_trained_forest")])
def test_the_registered_fits_learn_from_all_rows(house, monkeypatch, fit, trained):
    monkeypatch.setattr(query_book, "_models", {})
    monkeypatch.setattr(model_flows, fit, lambda house, **options: options)
    assert getattr(query_book, trained)(house) == {}
