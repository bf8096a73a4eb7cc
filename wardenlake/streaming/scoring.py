"""Structured Streaming jobs built from the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wardenlake.functions.storage import new_folder
from wardenlake.operators.reference_profile import ReferenceProfile, detect_drift_from_profile, write_profile
from wardenlake.operators.scoring import score_batch, windowed_flags
from wardenlake.schema import FEATURES, KEY, record_schema
from wardenlake.streaming.period_counts import PeriodCounts


def read_records(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    return spark.readStream.schema(schema or record_schema()).format(fmt).options(**options).load(path)


def score_stream(
    model, records: DataFrame, out: str, checkpoint: str, features=FEATURES, keep=(KEY,), fmt: str = "parquet", **trigger
) -> StreamingQuery:
    """Score records as they arrive, exactly once into a file sink."""
    scored = score_batch(model, records, features, keep)
    return (
        scored.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(out)
    )


def flag_rate_stream(
    scored: DataFrame, out: str, checkpoint: str, ts: str = "ts", every: str = "1 hour", **trigger
) -> StreamingQuery:
    """Flag counts per period, of every row however late.

    A micro-batch adds its counts to `PeriodCounts`, once however often it is replayed; `read_flag_rates` sums them up.
    Open periods are there from their first row on, and no row is dropped.
    """
    counts = PeriodCounts(scored.sparkSession, out)

    def add(batch: DataFrame, batch_id: int) -> None:
        counts.add(windowed_flags(batch, ts, every), batch_id)

    return (
        scored.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_flag_rates(spark: SparkSession, out: str) -> DataFrame:
    return PeriodCounts(spark, out).read()


def drift_stream(
    reference: DataFrame | ReferenceProfile, incoming: DataFrame, out: str, checkpoint: str, features=None, ks_alpha=0.05, psi_threshold=0.1, **trigger
) -> StreamingQuery:
    """Compare every micro-batch with a fixed reference.

    The reference is profiled once, or comes as a profile on disk, which restarts can share; micro-batches read of it what
    their own values leave undecided. A batch writes its own directory and overwrites it when it is replayed.
    """
    spark = incoming.sparkSession
    profile = reference if isinstance(reference, ReferenceProfile) else write_profile(reference, new_folder(spark), features)
    psi = profile.psi()

    def check(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.take(1):
                found = detect_drift_from_profile(profile, batch, features, ks_alpha, psi_threshold, psi=psi)
                found.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        incoming.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_drift(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).withColumn("batch_id", F.col("batch_id").cast("long"))
