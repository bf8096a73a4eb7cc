"""Money lost and saved by a classifier's decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardenlake.config import DEFAULTS
from wardenlake.operators.metrics import confusion_matrix
from wardenlake.operators.projections import apply_threshold
from wardenlake.operators.thresholds import threshold_counts


def price(
    counts: DataFrame,
    avg_fraud_amount: float = DEFAULTS.avg_fraud_amount,
    investigation_cost: float = DEFAULTS.investigation_cost,
    fraud_recovery_rate: float = DEFAULTS.fraud_recovery_rate,
) -> DataFrame:
    """Costs, savings and net benefit, in cents, of rows with threshold, tp, fp, fn, tn."""
    missed = F.col("fn") * F.lit(float(avg_fraud_amount)) * F.lit(1.0 - fraud_recovery_rate)
    alarms = F.col("fp") * F.lit(float(investigation_cost))
    saved = F.col("tp") * F.lit(float(avg_fraud_amount)) * F.lit(float(fraud_recovery_rate))
    return counts.select(
        "threshold",
        F.col("tp").alias("true_positives"),
        F.col("fp").alias("false_positives"),
        F.col("fn").alias("false_negatives"),
        F.col("tn").alias("true_negatives"),
        F.round(missed, 2).alias("fn_cost_usd"),
        F.round(alarms, 2).alias("fp_cost_usd"),
        F.round(saved, 2).alias("tp_savings_usd"),
        F.round(missed + alarms, 2).alias("total_cost_usd"),
        F.round(saved - (missed + alarms), 2).alias("net_benefit_usd"),
        F.lit(float(avg_fraud_amount)).alias("avg_fraud_amount"),
        F.lit(float(investigation_cost)).alias("investigation_cost"),
        F.lit(float(fraud_recovery_rate)).alias("fraud_recovery_rate"),
    )


def compute_financial_cost(
    df: DataFrame, label: str = "Class", score: str = "score", threshold: float = 0.5, **money
) -> DataFrame:
    decided = df.select(F.col(label).alias("y"), apply_threshold(score, threshold).alias("p"))
    counts = confusion_matrix(decided, "y", "p").withColumn("threshold", F.lit(float(threshold)))
    return price(counts, **money)


def cost_curve(df: DataFrame, label: str = "Class", score: str = "score", thresholds=None, **money) -> DataFrame:
    return price(threshold_counts(df, label, score, thresholds), **money)


def best_cost_threshold(df: DataFrame, label: str = "Class", score: str = "score", thresholds=None, **money) -> DataFrame:
    """The line of the cost curve with the highest net benefit; the lowest threshold wins a tie."""
    curve = cost_curve(df, label, score, thresholds, **money)
    line = F.max_by(F.struct(*curve.columns), F.struct(F.col("net_benefit_usd"), -F.col("threshold")))
    return curve.agg(line.alias("line")).select("line.*")
