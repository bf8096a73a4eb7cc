"""Profiles of a transaction table."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardenlake.functions.order_stats import exact_quantiles
from wardenlake.functions.storage import materialize
from wardenlake.functions.sums import summed
from wardenlake.schema import KEY, LABEL, numeric_columns

# of the density estimate: box and reach in bandwidths, terms of the expansion
BOX, REACH, TERMS = 0.5, 9.0, 16


def class_balance(df: DataFrame, target: str = LABEL) -> DataFrame:
    """Rows and share of every class."""
    counts = df.groupBy(target).agg(F.count("*").alias("n_rows"))
    total = counts.select(F.sum("n_rows")).scalar()
    return counts.withColumn("pct", F.lit(100.0) * F.col("n_rows") / total)


def fraud_share(df: DataFrame, target: str = LABEL) -> DataFrame:
    """One row: rows, positives and their percentage, 0.0 for an empty table."""
    n, positive = F.count("*"), F.count_if(F.col(target) == 1)
    pct = F.coalesce(F.try_divide(F.lit(100.0) * positive, n), F.lit(0.0))
    return df.agg(n.alias("n_rows"), positive.alias("n_fraud"), pct.alias("fraud_pct"))


def null_counts(df: DataFrame) -> DataFrame:
    """Type, missing and present values of every column, in one pass."""
    counted = df.agg(F.count("*").alias("__rows"), *[F.count(c).alias(c) for c in df.columns])
    long = counted.unpivot(["__rows"], df.columns, "column_name", "n_present")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return long.select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "n_present",
        (F.col("__rows") - F.col("n_present")).alias("n_missing"),
    )


def null_total(df: DataFrame) -> DataFrame:
    missing = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    return df.agg(missing.cast("long").alias("n_missing"))


def table_shape(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows and columns of the table, or of each part of it."""
    grouped = df.groupBy(by) if by else df.groupBy()
    width = len(df.columns) - (1 if by else 0)
    return grouped.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(width).cast("long"))


def describe_by_class(df: DataFrame, column: str = "Amount", target: str = LABEL) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max of one column per class."""
    quartiles = exact_quantiles(df, [column], [0.25, 0.5, 0.75], by=target)
    rows = [(group, *values) for (group, _), values in quartiles.items()]  # one row per class
    group_type = df.schema[target].dataType.simpleString()
    points = df.sparkSession.createDataFrame(rows, f"`{target}` {group_type}, q25 double, q50 double, q75 double")
    moments = df.groupBy(target).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    return moments.join(F.broadcast(points), target, "left").select(
        target, "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def mean_by_class(df: DataFrame, target: str = LABEL, exclude=(KEY,)) -> DataFrame:
    columns = numeric_columns(df, exclude=(*exclude, target))
    return df.groupBy(target).agg(*[F.avg(c).alias(c) for c in columns])


def _masked_products(batches: Iterator[pa.RecordBatch], shifts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """X'X, X'M, X2'M and M'M of shifted columns, M telling what is present, added up over a task."""
    total = np.zeros((4, len(shifts), len(shifts)))
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shifts
        m = (~np.isnan(x)).astype(float)
        x = np.where(m > 0, x, 0.0)
        total += np.stack([x.T @ x, x.T @ m, (x * x).T @ m, m.T @ m])
    flat = pa.ListArray.from_arrays(pa.array([0, total.size], pa.int32()), pa.array(total.ravel()))
    yield pa.RecordBatch.from_arrays([flat], ["part"])


def correlation_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Pearson correlation of every two numeric columns, over the rows where both are present; NULL where one doesn't vary.

    One scan finds means to shift by, for the differences below lose no digits then; a second one adds up four products
    of narrow matrices in every task, from which all pairs follow, columns with gaps included.
    """
    columns = list(columns or numeric_columns(df))
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = doubles.agg(*[F.avg(c).alias(c) for c in columns]).first()
    shifts = np.array([0.0 if means[c] is None else means[c] for c in columns])
    parts = doubles.mapInArrow(lambda batches: _masked_products(batches, shifts), "part array<double>")
    flat = summed(parts, 4 * len(columns) ** 2)
    products, sums_where, squares_where, both = flat.reshape(4, len(columns), len(columns))
    spread = both * squares_where - sums_where**2  # of the row's column, over the rows that have the other
    spread[spread <= 1e-12 * both * squares_where] = 0.0
    with np.errstate(invalid="ignore", divide="ignore"):
        corr = (both * products - sums_where * sums_where.T) / np.sqrt(spread * spread.T)
    rows = []
    for (i, a), (j, b) in itertools.product(enumerate(columns), repeat=2):
        known = spread[i, j] > 0 and spread[j, i] > 0
        rows.append((a, b, (1.0 if i == j else float(corr[i, j])) if known else None))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


def _gauss_moments(offset: Column) -> Column:
    """Sums of offset^k / k!, k < TERMS, each power by one product from the last."""
    return F.array(*[F.sum(F.pow(offset, F.lit(float(k)))) / math.factorial(k) for k in range(TERMS)])


def _gauss_sum(moments: Column, t: Column) -> Column:
    """Sum of moments[k] times the k-th Hermite function at t, by their recurrence."""
    state = F.struct(F.lit(0.0).alias("sum"), F.exp(-t * t).alias("now"), F.lit(0.0).alias("last"), F.lit(0.0).alias("k"))

    def step(s: Column, moment: Column) -> Column:
        ahead = F.lit(2.0) * t * s["now"] - F.lit(2.0) * s["k"] * s["last"]
        return F.struct((s["sum"] + moment * s["now"]).alias("sum"), ahead.alias("now"), s["now"].alias("last"), (s["k"] + 1.0).alias("k"))

    return F.aggregate(moments, state, step, lambda s: s["sum"])


def amount_density(
    df: DataFrame, column: str = "Amount", target: str = LABEL, points: int = 200, upper: float = 1000.0
) -> DataFrame:
    """Gaussian density estimate of the amounts of each class on an even grid from 0 to `upper`.

    A fast Gauss transform: one aggregation keeps TERMS moments for each class and box of half a bandwidth, and the boxes
    are expanded at the grid points they reach. An amount's kernel is off by less than 1e-15 of its height that way,
    and left out where it is below 1e-17 of it. The bandwidth is the sample deviation times n to the power -1/5;
    the density is NULL where that is 0 or undefined.
    """
    present = df.where(F.col(column).isNotNull()).select(F.col(target), F.col(column).cast("double").alias("__x"))
    spread = present.groupBy(target).agg(
        F.count("*").alias("n_class"),
        F.nullif(F.stddev_samp("__x") * F.pow(F.count("*").cast("double"), F.lit(-0.2)), F.lit(0.0)).alias("bandwidth"),
    )
    spread = materialize(spread)  # a row per class
    step, unit = upper / (points - 1), F.col("bandwidth") * math.sqrt(2.0)
    wide = F.col("bandwidth") * BOX
    center = (F.col("box") + 0.5) * wide
    boxed = present.join(F.broadcast(spread), target).where("bandwidth IS NOT NULL").withColumn("box", F.floor(F.col("__x") / wide))
    near = (F.col("__x") >= -REACH * F.col("bandwidth")) & (F.col("__x") <= upper + REACH * F.col("bandwidth"))
    boxes = boxed.where(near).groupBy(target, "n_class", "bandwidth", "box").agg(_gauss_moments((F.col("__x") - center) / unit).alias("moments"))
    low = F.greatest(F.lit(0), F.ceil((center - REACH * F.col("bandwidth")) / step))
    high = F.least(F.lit(points - 1), F.floor((center + REACH * F.col("bandwidth")) / step))
    placed = boxes.where(low <= high).withColumn("i", F.explode(F.sequence(low, high)))
    kernel = _gauss_sum(F.col("moments"), (F.col("i") * step - center) / unit)
    height = F.col("n_class") * F.col("bandwidth") * math.sqrt(2.0 * math.pi)
    sums = placed.groupBy(target, "i").agg(F.sum(kernel / height).alias("density"))
    grid = spread.select(target, "bandwidth", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("i"))
    return grid.join(sums, [target, "i"], "left").select(
        target, (F.col("i") * step).alias("x"), F.when(F.col("bandwidth").isNotNull(), F.coalesce("density", F.lit(0.0))).alias("density")
    )
