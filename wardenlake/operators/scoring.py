"""Scoring records with a fitted model; the same code serves batches and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wardenlake.operators.projections import align_schema, argmax_prediction, complement, label_text
from wardenlake.schema import FEATURES, KEY


def positive_score(df: DataFrame, probability: str = "probability", prediction: str = "prediction") -> Column:
    """The probability of class 1, or the class itself where a model gives no probabilities."""
    if probability in df.columns:
        return vector_to_array(F.col(probability))[1]
    return F.col(prediction).cast("double")


def decisions(prediction: Column, score: Column) -> list[Column]:
    return [
        prediction.cast("int").alias("prediction_class"),
        label_text(prediction).alias("prediction_label"),
        score.alias("fraud_probability"),
        complement(score).alias("legitimate_probability"),
    ]


def score_batch(model, df: DataFrame, features=FEATURES, keep=(KEY,)) -> DataFrame:
    """Align the records to the model's features and score them, batch or stream."""
    kept = [c for c in keep if c in df.columns]
    out = model.transform(align_schema(df, features, kept))
    return out.select(*kept, *decisions(F.col("prediction"), positive_score(out)))


def predict_single(spark: SparkSession, model, record: Mapping | DataFrame, features=FEATURES) -> DataFrame:
    """One record, a mapping or a table with one row, through the batch path. An absent or missing feature is 0.0."""
    if isinstance(record, DataFrame):
        key = F.coalesce(F.col(KEY).cast("long"), F.lit(0)) if KEY in record.columns else F.lit(0).cast("long")
        given = align_schema(record.withColumn(KEY, key), features)
        return score_batch(model, given.fillna(0.0, list(features)), features)
    given = [float(record[c]) if record.get(c) is not None else 0.0 for c in features]
    schema = T.StructType([T.StructField(KEY, T.LongType()), *[T.StructField(c, T.DoubleType()) for c in features]])
    return score_batch(model, spark.createDataFrame([(int(record.get(KEY) or 0), *given)], schema), features)


def logistic_score(df: DataFrame, intercept: float, coefficients: Mapping[str, float]) -> DataFrame:
    """Score with published coefficients instead of a fitted model."""
    margin = F.lit(float(intercept))
    for c, b in coefficients.items():
        margin = margin + F.lit(float(b)) * F.col(c)
    return df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def score_with_coefficients(df: DataFrame, intercept: float, coefficients: Mapping[str, float], keep=(KEY,)) -> DataFrame:
    out = logistic_score(align_schema(df, list(coefficients), keep), intercept, coefficients)
    return out.select(*keep, *decisions(argmax_prediction("score"), F.col("score")))


def flag_summary(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """One row: how many were scored, how many flagged."""
    return df.agg(
        F.count("*").alias("total_transactions"),
        F.coalesce(F.sum(F.col(prediction).cast("long")), F.lit(0)).alias("total_flagged_frauds"),
    )


def windowed_flags(df: DataFrame, ts: str = "ts", every: str = "1 hour", late: str = "1 hour", prediction: str = "prediction") -> DataFrame:
    """Scored and flagged rows per period. On a stream, rows later than `late` are left out."""
    if df.isStreaming and df.schema[ts].dataType == T.TimestampNTZType():
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))  # watermarks know no other type
    return (
        df.withWatermark(ts, late)
        .groupBy(F.window(ts, every).alias("period"))
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum(F.col(prediction).cast("long")).alias("total_flagged_frauds"),
        )
        .select(
            F.col("period.start").alias("window_start"),
            F.col("period.end").alias("window_end"),
            "total_transactions",
            "total_flagged_frauds",
        )
    )
