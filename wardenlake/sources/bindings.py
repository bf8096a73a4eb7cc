"""Views of the generic test tables that have the shape of a transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardenlake.functions.hashing import hash_key, unit_interval
from wardenlake.schema import COMPONENTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """These tables hold no NaN, so nothing stands between a filter and the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_micros(ts: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, whatever the session's time zone."""
    return F.expr(
        f"(datediff(cast({ts} as date), date'1970-01-01') * 86400L"
        f" + hour({ts}) * 3600 + minute({ts}) * 60) * 1000000L"
        f" + cast(extract(second from {ts}) * 1000000 as bigint)"
    )


def as_transactions(events: DataFrame, start: Column, *keep: str) -> DataFrame:
    """Events, batch or stream, as card transactions: Time, V1, V2, Amount and a rare Class."""
    return events.select(
        F.col("event_id").alias("tx_id"),
        ((epoch_micros("ts") - start) / F.lit(1e6)).alias("Time"),
        F.col("user_id").cast("double").alias("V1"),
        F.get_json_object("props", "$.k").cast("double").alias("V2"),
        F.col("value").alias("Amount"),
        F.when((F.col("event_type") == "error") & (F.col("value") >= 100), 1).otherwise(0).alias("Class"),
        *keep,
    )


def transactions(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # a scalar subquery: planned only when the query reads Time
    return as_transactions(events, events.select(F.min(epoch_micros("ts"))).scalar(), *keep)


def wide_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`embeddings` as transactions with all 28 components."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return vectors.select(
        F.col("vec_id").alias("tx_id"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(COMPONENTS)],
        F.when(F.col("label") == 0, 1).otherwise(0).alias("Class"),
    )


def scored_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with their timestamp and a score that leans towards the label and has ties."""
    u = unit_interval(hash_key("tx_id", 42))
    raw = F.lit(0.55) * u + F.lit(0.35) * F.col("Class") + F.lit(0.05)
    return transactions(spark, sf_dir, "ts").withColumn("score", F.floor(F.lit(1000.0) * raw) / F.lit(1000.0))


def with_missing_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).withColumn("Amount", F.when(F.col("tx_id") % 17 != 0, F.col("Amount")))


def early_and_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reference and current halves of the time range."""
    events = table(spark, sf_dir, "events")
    # drift makes several passes: find the bounds once
    first, last = events.agg(F.min(epoch_micros("ts")), F.max(epoch_micros("ts"))).first()
    tx, middle = as_transactions(events, F.lit(first)), F.lit((last - first) / 1e6 / 2)
    return tx.where(F.col("Time") < middle), tx.where(F.col("Time") >= middle)
