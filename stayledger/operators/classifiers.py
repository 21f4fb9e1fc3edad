"""Cancellation and churn classifiers on Spark ML: features, training, scoring, importances."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import accumulate, product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import buckets
from ..functions.risk import high_risk
from ..session import stored
from .preparation import row_hash, stratified_parts

# Feature columns.
SHARED_NUMERIC = [
    "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies",
    "is_repeated_guest", "previous_cancellations", "previous_bookings_not_canceled", "booking_changes", "adr",
    "required_car_parking_spaces", "total_of_special_requests", "days_in_waiting_list", "total_stay_nights",
    "total_guests", "year", "room_changed",
]
SHARED_CATEGORIES = [
    "month", "season", "hotel_name", "meal_plan", "market_segment", "distribution_channel", "country", "customer_type",
    "deposit_type", "reserved_room_type", "assigned_room_type",
]
CANCELLATION_NUMERIC = SHARED_NUMERIC + ["revenue", "is_weekend"]
CANCELLATION_CATEGORIES = SHARED_CATEGORIES
CHURN_NUMERIC = SHARED_NUMERIC
CHURN_CATEGORIES = SHARED_CATEGORIES
LEAKING_NUMERIC, LEAKING_CATEGORIES = ["is_canceled"], ["reservation_status"]

# What a scoring form assumes for features it does not ask for.
FORM_DEFAULTS = {
    "adults": 2, "children": 0.0, "babies": 0, "previous_cancellations": 0, "previous_bookings_not_canceled": 0,
    "required_car_parking_spaces": 0, "days_in_waiting_list": 0, "total_guests": 2.0, "year": 2017, "month": "August",
    "season": "Summer", "meal_plan": "BB", "country": "PRT", "reserved_room_type": "A", "assigned_room_type": "A",
    "room_changed": False, "is_weekend": False,
}
CHURN_FORM_DEFAULTS = {
    "lead_time": 30, "stays_in_weekend_nights": 1, "stays_in_week_nights": 2, "total_stay_nights": 3, "is_canceled": 0,
    "reservation_status": "Check-Out",
}


def _long(value: object) -> object:
    return F.lit(value).cast("bigint") if type(value) is int else F.lit(value)


def cancellation_form(df: DataFrame) -> DataFrame:
    """Complete partial cancellation inputs: nights split into weekend and week, revenue, bucket, default values."""
    nights = F.col("total_stay_nights")
    derived = {
        "stays_in_weekend_nights": F.least(F.lit(2), nights),
        "stays_in_week_nights": F.greatest(F.lit(0), nights - 2),
        "revenue": F.col("adr") * nights,
        "lead_time_bucket": buckets.LEAD_TIME.label_from_zero("lead_time"),
        "reservation_status": F.lit("Reserved"),
    }
    missing = {c: _long(v) for c, v in FORM_DEFAULTS.items() if c not in df.columns}
    return df.withColumns({**{c: v for c, v in derived.items() if c not in df.columns}, **missing})


def churn_form(df: DataFrame) -> DataFrame:
    """Complete partial churn inputs with default values."""
    defaults = {**FORM_DEFAULTS, **CHURN_FORM_DEFAULTS}
    return df.withColumns({c: _long(v) for c, v in defaults.items() if c not in df.columns})


def _feature_stages(numeric: list[str], categories: list[str], one_hot: bool = True) -> list:
    """Scaled numbers and one-hot categories; a category not seen in training becomes an all-zero block.

    Without ``one_hot`` a category stays one column that the trees split as a set of values. That keeps the training
    rows several times smaller, which matters more the larger the data; an unseen category is then a value of its own.
    """
    indexed, encoded = [f"{c}_index" for c in categories], [f"{c}_onehot" for c in categories]
    return [
        StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"),
        *([OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)] if one_hot else []),
        VectorAssembler(inputCols=numeric, outputCol="numbers", handleInvalid="error"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["scaled", *(encoded if one_hot else indexed)], outputCol="features"),
    ]


def _bins(train: DataFrame, categories: list[str], one_hot: bool) -> int:
    """Tree bins: the default, unless whole categories have to fit into them, unseen values included."""
    if one_hot:
        return 32
    most = train.agg(*[F.count_distinct(c).alias(c) for c in categories]).first()
    return max(32, max(most) + 1)


def bounded(train: DataFrame, most_rows: int | None, row_id: str = "booking_id", seed: int = 42) -> DataFrame:
    """At most ``most_rows`` labelled rows, those with the smallest hash of their id; all of them without a bound.

    Only the fit is bounded: splitting, scoring and evaluation go over all rows.
    """
    if most_rows is None:
        return train
    return train.orderBy(row_hash(row_id, seed), row_id).limit(most_rows)


def bounded_by_label(train: DataFrame, label: str, most_rows: int | None, row_id: str = "booking_id") -> DataFrame:
    """At most ``most_rows`` rows with every label in its share, of each those with the smallest hash of their id. The part
    was cut by the same hash, per label: the smallest hashes of all are of the label whose border is lower."""
    sizes = sorted((r[label], r["n"]) for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per label
    total = sum(n for _, n in sizes)
    if most_rows is None or total <= most_rows:
        return train
    upto = [int(n * most_rows / total + 0.5) for n in accumulate(n for _, n in sizes)]
    shares = [bounded(train.filter(F.col(label) == value), after - before, row_id) for (value, _), before, after in zip(sizes, [0, *upto], upto)]
    return reduce(DataFrame.unionAll, shares)


def training_rows(train: DataFrame, label: str, numeric: list[str], categories: list[str], most_rows: int | None, row_id: str = "booking_id") -> DataFrame:
    """The columns a fit needs of its labelled rows, written to the shared folder. A bounded sample comes out of one sort
    and would stay one partition; stored, it is read by as many tasks as :func:`_dealt` asks for."""
    folds = [c for c in ("fold",) if c in train.columns]
    return stored(bounded(train, most_rows, row_id).select(row_id, label, *numeric, *categories, *folds), "training-rows")


def _dealt(rows: DataFrame, n: int, task_rows: int, row_id: str) -> DataFrame:
    """``rows`` over tasks by hash of their id and sorted within, so that every run bags the same rows. Small samples get a
    task per ``task_rows``, as each round of a fit is a job; large ones a task per million rows, or the cluster's width."""
    width = min(-(-n // task_rows), max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // 1_000_000)))
    return rows.repartition(max(1, width), row_id).sortWithinPartitions(row_id)


def encoded(rows: DataFrame, numeric: list[str], categories: list[str], one_hot: bool, keep: list[str]) -> tuple[list, DataFrame]:
    """The fitted feature stages, and the rows as feature vectors, written once for all fits that read them."""
    fitted = Pipeline(stages=_feature_stages(numeric, categories, one_hot)).fit(rows)
    return fitted.stages, stored(fitted.transform(rows).select(*keep, "features"), "feature-rows")


def _forest(trees: int, depth: int, min_leaf: int, bins: int) -> RandomForestClassifier:
    """The node of every row is kept between rounds, with checkpoints, instead of sending the growing forest to the tasks. Each
    task holds the histograms of a round's nodes, so their memory is bounded: a wide level takes several rounds."""
    return RandomForestClassifier(
        labelCol="is_canceled", featuresCol="features", seed=42, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
        maxBins=bins, cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=512,
    )


def fit_cancellation(
    train: DataFrame, trees: int = 100, depth: int = 20, min_leaf: int = 1, grid: dict[str, list[int]] | None = None,
    parallelism: int = 4, one_hot: bool = True, most_rows: int | None = None,
) -> PipelineModel:
    """Random forest on ``is_canceled``. With ``grid`` (trees, depth, min_leaf), the best of :func:`grid_search`.
    ``most_rows`` bounds the labelled rows of the fit, see :func:`bounded`."""
    if grid is not None:
        results = grid_search(train, grid, parallelism=parallelism, one_hot=one_hot, most_rows=most_rows)
        best = best_combination(results)
        trees, depth, min_leaf = best["trees"], best["depth"], best["min_leaf"]
    rows = training_rows(train.drop("fold"), "is_canceled", CANCELLATION_NUMERIC, CANCELLATION_CATEGORIES, most_rows)
    stages, vectors = encoded(rows, CANCELLATION_NUMERIC, CANCELLATION_CATEGORIES, one_hot, ["booking_id", "is_canceled"])
    forest = _forest(trees, depth, min_leaf, _bins(rows, CANCELLATION_CATEGORIES, one_hot))
    return PipelineModel(stages=[*stages, forest.fit(_dealt(vectors, vectors.count(), 2_500, "booking_id"))])


def grid_search(
    train: DataFrame, grid: dict[str, list[int]], folds: int = 3, parallelism: int = 4, one_hot: bool = True, most_rows: int | None = None,
) -> DataFrame:
    """Every combination of ``grid`` (trees, depth, min_leaf) fitted on all folds but one and judged on that one: place (of
    the combination), depth, min_leaf, trees, fold, rows (of the fold), roc_auc. Folds are stratified by hash of the booking,
    and so is the choice of ``most_rows``. The area is null in a fold of one class.

    Folds and feature vectors are made once and shared by all fits. Spark ML limits the depth to 30, which stands for "no
    limit", and has no minimum split size, so the full search has 12 combinations: trees 100 and 200, depth 10, 20 and 30,
    leaf size 1 and 2. Feature stages are fitted on all folds: means and categories do not depend on the label.
    """
    thirds = {str(k): 1 / folds for k in range(folds)}
    parts = stratified_parts(bounded_by_label(train, "is_canceled", most_rows), "is_canceled", thirds, seed=7, name="fold")
    rows = training_rows(parts, "is_canceled", CANCELLATION_NUMERIC, CANCELLATION_CATEGORIES, None)
    stages, vectors = encoded(rows, CANCELLATION_NUMERIC, CANCELLATION_CATEGORIES, one_hot, ["booking_id", "is_canceled", "fold"])
    bins, n = _bins(rows, CANCELLATION_CATEGORIES, one_hot), vectors.count()

    def held_out(job: tuple[int, int, int, int, int]) -> DataFrame:
        place, depth, min_leaf, trees, fold = job
        inside = _dealt(vectors.filter(F.col("fold") != str(fold)).drop("fold"), n, 2_500, "booking_id")
        model = _forest(trees, depth, min_leaf, bins).setCheckpointInterval(-1).fit(inside)
        scored = model.transform(vectors.filter(F.col("fold") == str(fold))).select("is_canceled", positive().alias("p"))
        given = [F.lit(v).cast("int").alias(k) for k, v in zip(names, job)]
        return stored(scored.select(*given, "is_canceled", "p"), "fold-scores")

    names = ["place", "depth", "min_leaf", "trees", "fold"]
    combinations = list(enumerate(product(grid["depth"], grid["min_leaf"], grid["trees"])))
    jobs = [(place, *combination, k) for place, combination in combinations for k in range(folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = reduce(DataFrame.unionAll, pool.map(held_out, jobs))
    # All fits are judged together: per fit and fold, how often a positive ranks above a negative, ties counting half.
    by_score = scores.groupBy(*names, "p").agg(F.sum("is_canceled").alias("pos"), F.sum(1 - F.col("is_canceled")).alias("neg"))
    above = F.sum("pos").over(Window.partitionBy(*names).orderBy(F.desc("p"))) - F.col("pos")
    wins = by_score.withColumn("wins", F.col("neg") * (above + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    results = wins.groupBy(*names).agg((F.sum("pos") + F.sum("neg")).alias("rows"), F.round(F.try_divide(F.sum("wins"), pairs), 6).alias("roc_auc"))
    return stored(results, "grid")


def best_combination(results: DataFrame) -> dict[str, int]:
    """The combination with the highest mean area over its folds; on a tie the first one: depth before leaf size before
    trees, each in the order it was listed."""
    names = ["place", "depth", "min_leaf", "trees"]
    means = results.groupBy(*names).agg(F.round(F.avg("roc_auc"), 6).alias("mean"))
    return means.orderBy(F.desc("mean"), "place").first().asDict()


FULL_GRID = {"trees": [100, 200], "depth": [30, 10, 20], "min_leaf": [1, 2]}


def churn_features(with_leaking: bool = False) -> tuple[list[str], list[str]]:
    """Numeric and categorical churn features. Cancellation and status partly define the label, so they are opt-in."""
    return (
        CHURN_NUMERIC + (LEAKING_NUMERIC if with_leaking else []),
        CHURN_CATEGORIES + (LEAKING_CATEGORIES if with_leaking else []),
    )


def fit_churn(
    train: DataFrame, rounds: int = 200, rate: float = 0.05, depth: int = 5, with_leaking: bool = False,
    one_hot: bool = True, most_rows: int | None = None,
) -> PipelineModel:
    """Gradient-boosted trees on ``is_churned``. The lineage of the rounds is cut in the shared checkpoint folder.
    ``most_rows`` bounds the labelled rows of the fit, see :func:`bounded`."""
    numeric, categories = churn_features(with_leaking)
    rows = training_rows(train, "is_churned", numeric, categories, most_rows)
    stages, vectors = encoded(rows, numeric, categories, one_hot, ["booking_id", "is_churned"])
    boosted = GBTClassifier(
        labelCol="is_churned", featuresCol="features", seed=42, maxIter=rounds, stepSize=rate, maxDepth=depth,
        maxBins=_bins(rows, categories, one_hot),
    )
    return PipelineModel(stages=[*stages, boosted.fit(_dealt(vectors, vectors.count(), 5_000, "booking_id"))])


def positive() -> Column:
    """The probability of class 1; a model that has met class 0 alone knows no other."""
    return F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0))


def score(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Add the probability of class 1, the predicted class and the high-risk flag to the input columns."""
    *features, trees = model.stages
    vectors = PipelineModel(stages=features).transform(df)
    # A tree looks up many features of a row: in a dense vector each takes one step.
    scored = trees.transform(vectors.withColumn("features", array_to_vector(vector_to_array("features"))))
    return scored.select(
        *[F.col(c) for c in df.columns],
        positive().alias(name),
        F.col("prediction").cast("int").alias("prediction"),
    ).withColumn("high_risk", high_risk(name))


def feature_names(model: PipelineModel, numeric: list[str], categories: list[str]) -> list[str]:
    """A name for each place of the feature vector, category values written out."""
    indexer = next(s for s in model.stages if hasattr(s, "labelsArray"))
    one_hot = any("OneHot" in type(stage).__name__ for stage in model.stages)
    expanded = [f"{c}_{label}" for c, labels in zip(categories, indexer.labelsArray) for label in labels]
    return numeric + (expanded if one_hot else categories)


def importances(model: PipelineModel, numeric: list[str], categories: list[str]) -> list[tuple[str, float]]:
    names = feature_names(model, numeric, categories)
    values = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    if len(values) != len(names):
        raise ValueError(f"{len(values)} importances for {len(names)} feature names")
    return list(zip(names, values))


def feature_importance(spark, model: PipelineModel, numeric: list[str], categories: list[str], n: int = 20) -> DataFrame:
    """The n most important features with expanded category names: (feature, importance, rank)."""
    ranked = sorted(importances(model, numeric, categories), key=lambda pair: (-pair[1], pair[0]))[:n]
    rows = [(name, value, i) for i, (name, value) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "feature string, importance double, rank int")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
