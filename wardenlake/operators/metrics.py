"""Binary classification metrics from counts, and curves from one histogram of the scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.functions.order_stats import range_edges, running_totals

METRICS = ["accuracy", "precision", "recall", "f1", "mcc", "roc_auc", "pr_auc"]
ROWS_PER_RANGE = 1_000_000


def _ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "Class", prediction: str = "prediction", by: str | None = None) -> DataFrame:
    """tp, fp, fn, tn of the table, or of each of its groups."""
    y, p = F.col(label), F.col(prediction)
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation; 0 when a margin is empty. Doubles, for the product outgrows BIGINT."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    return _ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and MCC beside tp, fp, fn, tn."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "mcc": mcc(tp, fp, fn, tn),
        }
    )


def binary_metrics(df: DataFrame, label: str = "Class", prediction: str = "prediction", by: str | None = None) -> DataFrame:
    return rates(confusion_matrix(df, label, prediction, by))


# ---------------------------------------------------------------------------------------------
# curves


def ranking_score(score: str):
    """A row whose score is NULL or NaN ranks behind all others, and no threshold flags it."""
    value = F.col(score).cast("double")
    return F.coalesce(F.nanvl(value, F.lit(None)), F.lit(float("-inf")))


def curve_counts(
    df: DataFrame, label: str = "Class", score: str = "score", rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """One row per distinct score: positives and negatives at it, and at or above it. Rows without a score are at -Infinity."""
    ranked = df.select(F.col(label).alias("y"), ranking_score(score).alias("threshold"))
    points = ranked.groupBy("threshold").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg"))
    edges = range_edges(ranked.select("threshold"), "threshold", rows_per_range)
    return running_totals(points, "threshold", ["pos", "neg"], edges)


def _all_counts(df: DataFrame, label: str):
    whole = df.agg(
        F.struct(
            F.count_if(F.col(label) == 1).cast("double").alias("p"),
            F.count_if(F.col(label) == 0).cast("double").alias("n"),
        )
    ).scalar()
    return whole["p"], whole["n"]


def roc_curve(df: DataFrame, label: str = "Class", score: str = "score", **options) -> DataFrame:
    """The start (NULL threshold) and one point per distinct score."""
    p, n = _all_counts(df, label)
    points = curve_counts(df, label, score, **options).select(
        "threshold", F.try_divide(F.col("neg_upto"), n).alias("fpr"), F.try_divide(F.col("pos_upto"), p).alias("tpr")
    )
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def pr_curve(df: DataFrame, label: str = "Class", score: str = "score", **options) -> DataFrame:
    """The anchor (recall 0, precision 1) and one point per distinct score."""
    p, _ = _all_counts(df, label)
    points = curve_counts(df, label, score, **options).select(
        "threshold",
        F.try_divide(F.col("pos_upto"), p).alias("recall"),
        F.try_divide(F.col("pos_upto"), F.col("pos_upto") + F.col("neg_upto")).alias("precision"),
    )
    start = df.sparkSession.createDataFrame([(None, 0.0, 1.0)], "threshold double, recall double, precision double")
    return start.unionByName(points)


def curve_areas(df: DataFrame, label: str = "Class", score: str = "score", **options) -> DataFrame:
    """One row: areas under the ROC and the precision-recall curve, by trapezoids.

    The totals before a point are its totals less its own counts, so no neighbour is looked up.
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    tp, fp = F.col("pos_upto").cast("double"), F.col("neg_upto").cast("double")
    tp0, fp0 = tp - pos, fp - neg
    earlier = F.coalesce(F.try_divide(tp0, tp0 + fp0), F.lit(1.0))
    sums = curve_counts(df, label, score, **options).agg(
        F.sum(neg * (tp + tp0) / 2).alias("roc"),
        F.sum(pos * (tp / (tp + fp) + earlier) / 2).alias("pr"),
        F.sum(pos).alias("p"),
        F.sum(neg).alias("n"),
    )
    return sums.select(
        F.try_divide(F.col("roc"), F.col("p") * F.col("n")).alias("roc_auc"),
        F.try_divide(F.col("pr"), F.col("p")).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str = "Class", score: str = "score", **options) -> DataFrame:
    return curve_areas(df, label, score, **options).select("roc_auc")


def pr_auc(df: DataFrame, label: str = "Class", score: str = "score", **options) -> DataFrame:
    return curve_areas(df, label, score, **options).select("pr_auc")


def calculate_metrics(
    df: DataFrame, label: str = "Class", prediction: str = "prediction", score: str = "score", **options
) -> DataFrame:
    """One row with the seven metrics and the confusion matrix."""
    counts = binary_metrics(df, label, prediction)
    areas = curve_areas(df, label, score, **options)
    both = areas.select(F.struct("roc_auc", "pr_auc")).scalar()
    return counts.withColumn("__areas", both).select(
        "tp", "fp", "fn", "tn", *METRICS[:5], F.col("__areas.roc_auc"), F.col("__areas.pr_auc")
    )


# ---------------------------------------------------------------------------------------------
# reports


def classification_report(df: DataFrame, label: str = "Class", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, and their averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def side(name, hit, false_alarm, missed):
        return F.struct(
            F.lit(name).alias("class"),
            _ratio(hit, hit + false_alarm).alias("precision"),
            _ratio(hit, hit + missed).alias("recall"),
            _ratio(2 * hit, 2 * hit + false_alarm + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    sides = confusion_matrix(df, label, prediction).select(
        side("0", tn, fn, fp).alias("c0"), side("1", tp, fp, fn).alias("c1"), _ratio(tp + tn, tp + fp + fn + tn).alias("acc")
    )
    total = F.col("c0.support") + F.col("c1.support")

    def average(name, weight0, weight1):
        return F.struct(
            F.lit(name).alias("class"),
            *[
                _ratio(weight0 * F.col(f"c0.{m}") + weight1 * F.col(f"c1.{m}"), weight0 + weight1).alias(m)
                for m in ("precision", "recall", "f1")
            ],
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        F.col("acc").alias("precision"),
        F.col("acc").alias("recall"),
        F.col("acc").alias("f1"),
        total.alias("support"),
    )
    lines = F.array(
        F.col("c0"),
        F.col("c1"),
        accuracy,
        average("macro avg", F.lit(1.0), F.lit(1.0)),
        average("weighted avg", F.col("c0.support").cast("double"), F.col("c1.support").cast("double")),
    )
    return sides.select(F.inline(lines))


def compare_models(metrics: DataFrame, models, model: str = "model", names=METRICS) -> DataFrame:
    """Metric by model matrix of a table with one row per model."""
    present = [m for m in names if m in metrics.columns]
    long = metrics.unpivot([model], present, "metric", "value")
    return long.groupBy("metric").pivot(model, list(models)).agg(F.first("value"))
