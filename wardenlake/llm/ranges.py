"""Cutting a table into ranges of an integer key."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

MOST_RANGES = 100_000
RANGE_BYTES = 8 << 20
RANGES_PER_CORE = 4


def wanted_ranges(df: DataFrame, text: str, size: int = RANGE_BYTES) -> int:
    """So many ranges that each has about `size` bytes of text, and every core some."""
    total = df.select(F.sum(F.octet_length(text).cast("long") + 16)).first()[0] or 0
    least = RANGES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return min(MOST_RANGES, max(least, -(-total // size)))


def key_splits(df: DataFrame, key: str, n: int) -> list[int]:
    """At most n keys of the table, ascending, the smallest first; between two of them are about equally many rows."""
    shares = [i / n for i in range(n)]
    found = df.select(F.percentile_approx(key, F.lit(shares), F.lit(max(10_000, 4 * n)))).first()[0]
    low = df.select(F.min(key)).first()[0]
    return sorted({low, *found}) if found else []


def count_ranges(splits: list[int]) -> int:
    return max(1, len({float(s) for s in splits}))


def with_range(df: DataFrame, key: str, splits: list[int], name: str, nulls_last: bool = False) -> DataFrame:
    """Adds `name`: the number, from 0, of the range of the key. Keys that are one DOUBLE are in one range."""
    inner = sorted({float(s) for s in splits})[1:]
    if not inner:
        return df.withColumn(name, F.lit(0))
    key_copy, number = f"__{name}_key", f"__{name}_number"
    cut = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol=key_copy, outputCol=number, handleInvalid="keep")
    numbered = cut.transform(df.withColumn(key_copy, F.col(key).cast("double")))
    placed = F.when(F.col(key).isNull(), F.lit(len(inner) if nulls_last else 0)).otherwise(F.col(number).cast("int"))
    return numbered.withColumn(name, placed).drop(key_copy, number)
