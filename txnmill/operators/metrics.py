"""Classification metrics on a scored table (label, score).

Rows are first aggregated to one row per distinct score, so ties are merged and a score that many
rows share costs one row. Ranks then come from bucketed running sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import safe_ratio
from .order import running_sums, with_buckets

METRICS = ("precision", "recall", "f1_score", "roc_auc", "pr_auc")


def _ratio(a, b):
    return F.try_divide(a, b)


def score_curve(df: DataFrame, label: str = "label", score: str = "prob", buckets: int | None = None) -> DataFrame:
    """One row per distinct score: positives, negatives, and both counted from the top down to it.

    A missing score is an error: a row without one has no rank, and dropping it would change the metrics.
    """
    value = F.col(score).cast("double")
    missing = value.isNull() | F.isnan(value)
    checked = F.when(missing, F.raise_error(F.lit("a score is missing")).cast("double")).otherwise(value)
    scored = df.select(F.col(label).cast("long").alias("label"), checked.alias("score"))
    points = (
        with_buckets(scored, ["score"], buckets)
        .where(F.col("score__b").isNotNull())
        .groupBy("score__b", "score")
        .agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    )
    return running_sums(points, "score", ["pos", "neg"], "score__b", [], descending=True)


def precision_recall_curve(df: DataFrame, label: str = "label", score: str = "prob", buckets: int | None = None) -> DataFrame:
    """(threshold, precision, recall): one point per distinct score, and the closing point at recall 0 and
    precision 1, which has no threshold."""
    curve = score_curve(df, label, score, buckets)
    positives = df.agg(F.sum(F.col(label).cast("long")).alias("p")).scalar()
    points = curve.select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _ratio(F.col("cum_pos"), positives).alias("recall"),
    )
    closing = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.union(closing)


def classification_metrics(
    df: DataFrame, label: str = "label", score: str = "prob", threshold: float = 0.5, buckets: int | None = None
) -> DataFrame:
    """precision, recall, f1_score at the threshold (0 where undefined), roc_auc (null if only one
    class is present) and pr_auc as the step sum over distinct scores."""
    curve = score_curve(df, label, score, buckets)
    over = F.col("score") >= F.lit(threshold)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    sums = curve.agg(
        F.sum(pos).alias("P"),
        F.sum(neg).alias("N"),
        F.sum(F.when(over, pos).otherwise(0.0)).alias("tp"),
        F.sum(F.when(over, neg).otherwise(0.0)).alias("fp"),
        F.sum(pos * (neg / 2 - F.col("cum_neg"))).alias("above"),
        F.sum(pos * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("steps"),
    )
    return sums.select(
        safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        safe_ratio(F.col("tp"), F.col("P")).alias("recall"),
        safe_ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P")).alias("f1_score"),
        (_ratio(F.col("above"), F.col("P") * F.col("N")) + 1.0).alias("roc_auc"),
        safe_ratio(F.col("steps"), F.col("P")).alias("pr_auc"),
    )


def threshold_metrics(df: DataFrame, label: str = "label", predicted: str = "pred") -> DataFrame:
    """precision, recall, f1_score of given predictions, in one aggregate."""
    y, p = F.col(label), F.col(predicted)
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return counts.select(
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def long_metrics(wide: DataFrame, stage: str) -> DataFrame:
    """(stage, metric, value) from a one-row metrics table."""
    return wide.withColumn("stage", F.lit(stage)).unpivot(["stage"], list(wide.columns), "metric", "value")


def evaluate(df: DataFrame, stage: str = "test", label: str = "label", score: str = "prob", threshold: float = 0.5) -> DataFrame:
    return long_metrics(classification_metrics(df, label, score, threshold), stage)


def confusion_matrix(df: DataFrame, label: str = "label", predicted: str = "pred") -> DataFrame:
    """Four rows (label, predicted, n); an empty cell is 0."""
    y, p = F.col(label), F.col(predicted)
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    counts = df.agg(*[F.count_if((y == a) & (p == b)).alias(f"n{a}{b}") for a, b in cells])
    rows = [F.struct(F.lit(a).alias("label"), F.lit(b).alias("predicted"), F.col(f"n{a}{b}").alias("n")) for a, b in cells]
    return counts.select(F.inline(F.array(*rows)))
