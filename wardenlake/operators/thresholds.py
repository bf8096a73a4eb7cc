"""Threshold search: every threshold's confusion matrix from one pass over the scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from wardenlake.operators.metrics import ranking_score, rates


def default_thresholds(n: int = 200, low: float = 0.01, high: float = 0.99) -> list[float]:
    """Evenly spaced, both ends included."""
    step = (high - low) / (n - 1)
    return [low + i * step for i in range(n - 1)] + [high]


def threshold_counts(
    df: DataFrame, label: str = "Class", score: str = "score", thresholds: Sequence[float] | None = None
) -> DataFrame:
    """tp, fp, fn, tn at each threshold (`score >= threshold`, never true without a score).

    Scores are counted by the number of thresholds they reach; running totals over those few
    counts give all the matrices.
    """
    cuts = sorted(set(default_thresholds() if thresholds is None else map(float, thresholds)))
    bucket = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="score", outputCol="reached")
    pairs = df.select(F.col(label).alias("y"), ranking_score(score).alias("score"))
    counts = (
        bucket.transform(pairs)
        .groupBy(F.col("reached").cast("int").alias("reached"))
        .agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    )
    grid = df.sparkSession.createDataFrame(
        [(i, c) for i, c in enumerate([-math.inf, *cuts])], "reached int, threshold double"
    )
    above = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy(F.lit(0))
    filled = grid.join(counts, "reached", "left").fillna(0, ["pos", "neg"])  # one row per threshold
    tp, fp = F.sum("pos").over(above), F.sum("neg").over(above)
    return (
        filled.select(
            "reached",
            "threshold",
            tp.alias("tp"),
            fp.alias("fp"),
            (F.sum("pos").over(every) - tp).alias("fn"),
            (F.sum("neg").over(every) - fp).alias("tn"),
        )
        .where(F.col("reached") > 0)
        .drop("reached")
    )


def threshold_curve(df: DataFrame, label: str = "Class", score: str = "score", thresholds=None) -> DataFrame:
    """Counts, precision, recall, F1 and MCC at each threshold."""
    return rates(threshold_counts(df, label, score, thresholds))


def find_optimal_threshold(
    df: DataFrame, label: str = "Class", score: str = "score", metric: str = "f1", thresholds=None
) -> DataFrame:
    """The threshold with the best F1 or MCC; the lowest one wins a tie."""
    metric = metric.lower()
    if metric not in ("f1", "mcc"):
        raise ValueError(f"metric must be 'f1' or 'mcc', got '{metric}'")
    curve = threshold_curve(df, label, score, thresholds)
    fields = F.struct("threshold", "precision", "recall", "f1", "mcc")
    best = curve.agg(F.max_by(fields, F.struct(F.col(metric), -F.col("threshold"))).alias("best"))
    return best.select(
        F.col("best.threshold").alias("optimal_threshold"),
        F.col(f"best.{metric}").alias("best_score"),
        F.lit(metric).alias("metric_optimised"),
        *[F.col(f"best.{m}") for m in ("precision", "recall", "f1", "mcc")],
    )
