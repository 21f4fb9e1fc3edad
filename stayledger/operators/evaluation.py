"""Quality of binary predictions: label and prediction are 0/1, score is a number that ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.measures import rows, rows_where
from .running import running_totals_descending


def _ratio(part: Column, whole: Column) -> Column:
    """Share as a double; 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * 1.0, whole), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def _cells(label: str, prediction: str) -> list[Column]:
    return [
        rows_where((F.col(label) == a) & (F.col(prediction) == p)).alias(f"n{a}{p}") for a in (0, 1) for p in (0, 1)
    ]


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1, from one pass."""
    cells = df.agg(*_cells(label, prediction))
    precision = _ratio(F.col("n11"), F.col("n11") + F.col("n01"))
    recall = _ratio(F.col("n11"), F.col("n11") + F.col("n10"))
    total = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    return cells.select(
        F.round(_ratio(F.col("n00") + F.col("n11"), total), 6).alias("accuracy"),
        F.round(precision, 6).alias("precision"),
        F.round(recall, 6).alias("recall"),
        F.round(_f1(precision, recall), 6).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, also empty ones."""
    lines = F.array(
        *[
            F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"n{a}{p}").alias("count"))
            for a in (0, 1)
            for p in (0, 1)
        ]
    )
    return df.agg(*_cells(label, prediction)).select(F.inline(lines))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    cells = df.agg(*_cells(label, prediction))
    total = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    figures = {}
    for c in (0, 1):
        hit, support = F.col(f"n{c}{c}"), F.col(f"n{c}0") + F.col(f"n{c}1")
        precision, recall = _ratio(hit, F.col(f"n0{c}") + F.col(f"n1{c}")), _ratio(hit, support)
        figures[c] = (precision, recall, _f1(precision, recall), support)
    accuracy = _ratio(F.col("n00") + F.col("n11"), total)
    macro = [(a + b) / 2 for a, b in zip(figures[0][:3], figures[1][:3])]
    weighted = [_ratio(a * figures[0][3] + b * figures[1][3], total) for a, b in zip(figures[0][:3], figures[1][:3])]
    nothing = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.round(precision, 6).alias("precision"),
            F.round(recall, 6).alias("recall"),
            F.round(f1, 6).alias("f1"),
            support.alias("support"),
        )

    lines = F.array(
        line("0", *figures[0]),
        line("1", *figures[1]),
        line("accuracy", nothing, nothing, accuracy, total),
        line("macro avg", *macro, total),
        line("weighted avg", *weighted, total),
    )
    return cells.select(F.inline(lines))


def _by_score(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positive and negative rows per distinct score, with their running totals from the highest score down."""
    counts = df.groupBy(F.col(score).alias("score")).agg(
        rows_where(F.col(label) == 1).alias("pos"), rows_where(F.col(label) == 0).alias("neg")
    )
    return running_totals_descending(counts, "score", ["pos", "neg"])


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve: how often a positive ranks above a negative, ties counting half."""
    ranked = _by_score(df, label, score)
    wins = F.sum(F.col("neg") * (F.col("upto_pos") - F.col("pos") + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.round(F.try_divide(wins, pairs), 6).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", all_points: bool = False) -> DataFrame:
    """False and true positive rate at the distinct scores, starting at (0, 0) above the highest one.

    A point is left out where the curve goes on by the same step, as many positives and negatives, behind it as before it;
    the first and the last score stay. With ``all_points`` none is left out. The area below is the same.
    """
    ranked = _by_score(df, label, score)
    totals = ranked.agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"), F.max("score").alias("top"))
    negatives, positives = totals.select("neg").scalar(), totals.select("pos").scalar()
    same_step = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
    first = F.col("upto_pos") + F.col("upto_neg") == F.col("pos") + F.col("neg")
    kept = ranked if all_points else ranked.filter(first | ~F.coalesce(same_step, F.lit(False)))
    points = kept.select(
        F.col("score").alias("threshold"),
        F.round(F.try_divide("upto_neg", negatives), 6).alias("fpr"),
        F.round(F.try_divide("upto_pos", positives), 6).alias("tpr"),
    )
    start = totals.select((F.col("top") + 1).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)
