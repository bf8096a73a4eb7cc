"""Bounds on what a Python worker holds at a time, and samples of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BATCH_BYTES = 4 << 20
BATCH_ROWS = 4000
SAMPLE_BITS = 53


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand texts to Python in batches of a few megabytes, whatever the length of a row."""
    for name, most in (("maxBytesPerBatch", BATCH_BYTES), ("maxRecordsPerBatch", BATCH_ROWS)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name)
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sampled(rows: int, of: int, *key: str) -> Column:
    """Whether a row is among about `rows` of `of`, by a hash of the key columns; all are if there are no more."""
    share = min(1.0, rows / max(1, of))
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - SAMPLE_BITS) < int(share * (1 << SAMPLE_BITS))
