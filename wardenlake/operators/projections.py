"""Projections, filters and scalar rules on records and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.schema import COMPONENTS, FEATURES, KEY, LABEL


def project_features(df: DataFrame, target: str = LABEL) -> DataFrame:
    return df.drop(target)


def align_schema(df: DataFrame, features=FEATURES, keep=(KEY,)) -> DataFrame:
    """The scoring columns in their fixed order: absent ones become 0.0, others are dropped."""
    kept = [F.col(c) for c in keep if c in df.columns]
    return df.select(
        *kept, *[(F.col(c).cast("double") if c in df.columns else F.lit(0.0)).alias(c) for c in features]
    )


def record_defaults(df: DataFrame, required=("Time", "Amount"), optional=COMPONENTS) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) records: a missing component is 0.0, a missing required value rejects."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        return df.limit(0), df
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    fills = {c: F.coalesce(F.col(c), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in optional}
    return df.where(complete).withColumns(fills), df.where(~complete)


def filter_class(df: DataFrame, value: int, target: str = LABEL) -> DataFrame:
    return df.where(F.col(target) == value)


def apply_threshold(score: str | Column, threshold: float) -> Column:
    """1 where the score reaches the threshold."""
    if not 0.0 < threshold < 1.0:
        raise ValueError(f"threshold must be in (0, 1), got {threshold}")
    col = F.col(score) if isinstance(score, str) else score
    return (col >= F.lit(float(threshold))).cast("int")


def argmax_prediction(score: str | Column) -> Column:
    """The default decision: a score of exactly 0.5 stays class 0."""
    col = F.col(score) if isinstance(score, str) else score
    return (col > F.lit(0.5)).cast("int")


def label_text(prediction: str | Column, positive: str = "Fraudulent", negative: str = "Legitimate") -> Column:
    col = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.when(col == 1, positive).otherwise(negative)


def complement(score: str | Column) -> Column:
    col = F.col(score) if isinstance(score, str) else score
    return F.lit(1.0) - col


def report_key(name: str | Column) -> Column:
    """The file-name form of a model's name."""
    col = F.lit(name) if isinstance(name, str) else name
    return F.regexp_replace(F.lower(col), " ", "_")


def preview(df: DataFrame, n: int = 5, last: bool = False, key: str = KEY) -> DataFrame:
    return df.orderBy(F.desc(key) if last else F.asc(key)).limit(n)
