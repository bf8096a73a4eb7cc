"""Splits, folds and samples that depend on row keys only.

Rows are put in a random order by a hash of their key. A part of that order is then everything
up to a cut-off key, so assigning a row to its part is a comparison: no row is moved or ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.hashing import hash_key
from wardenlake.functions.order_stats import key_cutoffs
from wardenlake.schema import KEY, LABEL, require_columns


def _per_group(group, cutoffs: dict, slot: int):
    """The cut-off of a row's group; a group without one gets a key below all others."""
    branches = F.when(F.lit(False), F.lit(""))
    for value, keys in cutoffs.items():
        branches = branches.when(group.eqNullSafe(F.lit(value)), F.lit(keys[slot] or ""))
    return branches.otherwise(F.lit(""))


def stratified_split(
    df: DataFrame, target: str = LABEL, test_size: float = 0.2, seed: int = 42, stratify: bool = True, key: str = KEY
) -> DataFrame:
    """Add `split`: exactly round(n * test_size) rows of every class are 'test'."""
    require_columns(df, [target, key])
    group = F.col(target) if stratify else F.lit(0)
    order = hash_key(key, seed)
    cut = key_cutoffs(df, order, [lambda n: F.round(n * F.lit(float(test_size)))], by=group)
    in_test = order <= _per_group(group, cut, 0)
    return df.withColumn("split", F.when(in_test, "test").otherwise("train"))


def stratified_folds(df: DataFrame, folds: int = 5, target: str = LABEL, seed: int = 42, key: str = KEY) -> DataFrame:
    """Add `fold` (0 ... folds-1): the fold sizes of a class differ by at most one row."""
    require_columns(df, [target, key])
    order = hash_key(key, seed)

    def end_of(i):
        # the first n mod folds folds hold one row more
        return lambda n: F.floor(n / folds) * (i + 1) + F.least(n % folds, F.lit(i + 1))

    cuts = key_cutoffs(df, order, [end_of(i) for i in range(folds - 1)], by=F.col(target))
    passed = [(order > _per_group(F.col(target), cuts, i)).cast("int") for i in range(folds - 1)]
    return df.withColumn("fold", sum(passed, F.lit(0)).cast("int"))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key: str = KEY) -> DataFrame:
    """Exactly min(n, rows) rows without replacement."""
    order = hash_key(key, seed)
    cut = key_cutoffs(df, order, [lambda total: F.least(total, F.lit(int(n)))])
    keys = cut.get(0)
    return df.where(order <= F.lit(keys[0])) if keys and keys[0] else df.limit(0)


def class_weights(df: DataFrame, target: str = LABEL) -> DataFrame:
    """`n_rows / (classes * n_class)` of every class."""
    counts = df.groupBy(target).agg(F.count("*").alias("n_rows"))
    whole = counts.agg(F.struct(F.sum("n_rows").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn("weight", whole["n"].cast("double") / (whole["k"] * F.col("n_rows")))


def with_class_weights(df: DataFrame, target: str = LABEL, column: str = "weight") -> DataFrame:
    weights = {r[target]: r["weight"] for r in class_weights(df, target).collect()}  # one row per class
    branches = F.when(F.lit(False), F.lit(0.0))
    for value, weight in weights.items():
        branches = branches.when(F.col(target) == value, F.lit(weight))
    return df.withColumn(column, branches)
