"""Feature drift between a reference and a current table: PSI and the two-sample KS statistic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wardenlake.functions.order_stats import exact_quantiles, log_bucket, long_form, zoom
from wardenlake.functions.storage import materialize
from wardenlake.schema import KEY, numeric_columns

OPEN_ROWS = 1_000_000  # rows whose values are put in order one by one
SLICES = 64  # few, so that a map task's rows collapse into their buckets
LOCAL_BUCKETS = 20_000
BROADCAST_BUCKETS = 1_000_000
EPS = 1e-8


def shared_features(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> tuple[list[str], list[str]]:
    """(requested, those both tables have). The default is every numeric column of the reference."""
    requested = list(features) if features is not None else numeric_columns(reference, exclude=(KEY,))
    return requested, [c for c in requested if c in reference.columns and c in current.columns]


# ---------------------------------------------------------------------------------------------
# PSI


@dataclass(frozen=True)
class PsiProfile:
    """The reference side of PSI: bin edges and counts, at most n_bins + 1 numbers per feature."""

    edges: dict[str, list[float]]
    counts: dict[tuple[str, int], int]


def _bin_counts(df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """(feature, bin, n) of the present values; bin -1 holds those outside all bins."""

    def bin_of(c: str) -> Column:
        value, cuts = F.col(c).cast("double"), edges[c]
        number = F.when(value.isNull(), F.lit(None))
        number = number.when((value < cuts[0]) | (value > cuts[-1]), F.lit(-1))
        for i, right in enumerate(cuts[1:-1]):
            number = number.when(value < right, F.lit(i))
        return number.otherwise(F.lit(max(len(cuts) - 2, 0)))

    columns = list(edges)
    numbered = df.select(*[bin_of(c).cast("int").alias(c) for c in columns])
    long = numbered.unpivot([], columns, "feature", "bin").where(F.col("bin").isNotNull())
    return long.groupBy("feature", "bin").agg(F.count("*").alias("n"))


def fit_psi(reference: DataFrame, features: Sequence[str] | None = None, n_bins: int = 10) -> PsiProfile:
    columns = list(features) if features is not None else numeric_columns(reference, exclude=(KEY,))
    deciles = exact_quantiles(reference, columns, [i / n_bins for i in range(n_bins + 1)]) if columns else {}
    edges = {c: sorted(set(v)) for (_, c), v in deciles.items()}
    found = _bin_counts(reference, edges).collect() if edges else []  # n_bins + 1 rows per feature
    return PsiProfile(edges, {(r["feature"], r["bin"]): r["n"] for r in found})


def compute_psi(
    reference: DataFrame | PsiProfile, current: DataFrame, features: Sequence[str] | None = None, n_bins: int = 10
) -> DataFrame:
    """(feature, psi) over the quantile bins of the reference, which may come as a fitted profile.

    Bins are closed on the left, the last one on both sides. Current values outside all bins
    count in the denominator only. A constant reference gives 0.
    """
    spark = current.sparkSession
    if not isinstance(reference, PsiProfile):
        reference = fit_psi(reference, shared_features(reference, current, features)[1], n_bins)
    edges = {c: v for c, v in reference.edges.items() if c in current.columns and (features is None or c in features)}
    if not edges:
        return spark.createDataFrame([], "feature string, psi double")
    bins = [
        (c, b, len(cuts) > 1 and b >= 0, reference.counts.get((c, b), 0))
        for c, cuts in edges.items()
        for b in range(-1, max(len(cuts) - 1, 1))
    ]
    every = Window.partitionBy("feature")
    shares = (
        F.broadcast(spark.createDataFrame(bins, "feature string, bin int, counts boolean, n_ref long"))
        .join(_bin_counts(current, edges).withColumnRenamed("n", "n_cur"), ["feature", "bin"], "left")
        .fillna(0, ["n_cur"])
        .select(
            "feature",
            "counts",
            (F.col("n_ref") / (F.sum("n_ref").over(every) + F.lit(EPS)) + F.lit(EPS)).alias("r"),
            (F.col("n_cur") / (F.sum("n_cur").over(every) + F.lit(EPS)) + F.lit(EPS)).alias("c"),
            F.sum("n_cur").over(every).alias("all_cur"),
        )
        .where(F.col("all_cur") > 0)
    )
    term = F.when(F.col("counts"), (F.col("c") - F.col("r")) * F.log(F.col("c") / F.col("r"))).otherwise(F.lit(0.0))
    return shares.groupBy("feature").agg(F.sum(term).alias("psi"))


def psi_band(psi: str | Column = "psi") -> Column:
    col = F.col(psi) if isinstance(psi, str) else psi
    return F.when(col < 0.1, "none").when(col < 0.2, "moderate").otherwise("significant")


# ---------------------------------------------------------------------------------------------
# KS


def ks_statistic(reference: DataFrame, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, n_ref, n_cur, ks_statistic), exact.

    The two distribution functions are compared at bucket ends first. Inside a bucket their gap
    cannot grow by more than the bucket's own share of rows, so only buckets that could still
    beat the largest gap seen are looked into; the others never leave their map task. They are
    cut finer until few rows are left, whose distinct values are then put in order.
    """
    _, columns = shared_features(reference, current, features)
    if not columns:
        return reference.sparkSession.createDataFrame([], "feature string, n_ref long, n_cur long, ks_statistic double")

    def side(df, r, c):
        return long_form(df, columns).withColumns({"r": F.lit(r).cast("long"), "c": F.lit(c).cast("long")})

    rows = (
        side(reference, 1, 0)
        .unionByName(side(current, 0, 1))
        .withColumns({"parent": F.lit(0).cast("long"), "b": log_bucket(F.col("value"))})
    )
    return largest_gaps(_histogram(rows), lambda _: rows)


NAME = ["feature", "parent", "b"]


def _sums() -> list[Column]:
    return [F.sum("r").alias("r"), F.sum("c").alias("c")]


def _histogram(rows: DataFrame) -> DataFrame:
    """One row per bucket; written, for several small queries read it."""
    return materialize(rows.groupBy(*NAME).agg(*_sums(), F.min("value").alias("lo"), F.max("value").alias("hi")))


def largest_gaps(counts: DataFrame, rows_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(feature, n_ref, n_cur, ks_statistic) from a written histogram (feature, parent, b, r, c, lo, hi) of two tables.

    `r` and `c` count rows of the reference and the current table. `rows_of` gives the rows (feature, parent, b, value, r, c)
    at least of the undecided buckets it is told, once.
    """
    spark, sums = counts.sparkSession, _sums()
    out_schema = "feature string, n_ref long, n_cur long, ks_statistic double"
    rows = None
    totals = {
        f["feature"]: (f["r"], f["c"])
        for f in counts.groupBy("feature").agg(*sums).collect()  # one row per feature
        if f["r"] and f["c"]
    }
    if not totals:
        return spark.createDataFrame([], out_schema)
    best = dict.fromkeys(totals, 0.0)
    sizes = spark.createDataFrame([(f, *n) for f, n in totals.items()], "feature string, n_ref long, n_cur long")
    zero = F.lit(0).cast("long")
    starts = sizes.select("feature", zero.alias("parent"), zero.alias("r0"), zero.alias("c0"))

    def gap(r: Column, c: Column) -> Column:
        return r / F.col("n_ref") - c / F.col("n_cur")

    def raise_best(gaps: DataFrame) -> None:
        for f in gaps.groupBy("feature").agg(F.max("gap").alias("gap")).collect():
            best[f["feature"]] = max(best[f["feature"]], f["gap"])

    def reached(counts: DataFrame, order: str) -> DataFrame:
        """Rows of both tables up to each bucket or value: those before its parent and within it."""
        within = Window.partitionBy("feature", "parent").orderBy(order)
        placed = counts.join(F.broadcast(sizes), "feature").join(starts, ["feature", "parent"])
        placed = placed.withColumns(
            {"r1": F.col("r0") + F.sum("r").over(within), "c1": F.col("c0") + F.sum("c").over(within)}
        )
        return placed.withColumn("gap", F.abs(gap(F.col("r1"), F.col("c1"))))

    while True:
        placed = reached(counts, "b")
        raise_best(placed)
        r0, c0 = F.col("r1") - F.col("r"), F.col("c1") - F.col("c")
        possible = F.greatest(gap(F.col("r1"), c0), -gap(r0, F.col("c1")))
        floor = spark.createDataFrame(list(best.items()), "feature string, best double")
        undecided = (
            placed.join(F.broadcast(floor), "feature")
            .where((possible > F.col("best")) & (F.col("lo") < F.col("hi")))
            .select(*NAME, "lo", "hi", r0.alias("r0"), c0.alias("c0"), (F.col("r") + F.col("c")).alias("n"))
        )
        found = undecided.limit(LOCAL_BUCKETS + 1).collect()
        if not found:
            break
        if len(found) <= LOCAL_BUCKETS:
            schema = T.StructType([*undecided.schema.fields, T.StructField("next", T.LongType())])
            brackets = spark.createDataFrame([(*f, i) for i, f in enumerate(found)], schema)
            size, open_rows = len(found), sum(f["n"] for f in found)
        else:
            brackets = materialize(undecided.withColumn("next", F.monotonically_increasing_id()))
            size, open_rows = brackets.agg(F.count("*"), F.sum("n")).first()
        ends = brackets.select(*NAME, "next", "lo", "hi")
        rows = rows_of(brackets) if rows is None else rows
        # beyond the limit Spark joins by the table's size
        rows = zoom(rows, F.broadcast(ends) if size <= BROADCAST_BUCKETS else ends, NAME, SLICES)
        starts = brackets.select("feature", F.col("next").alias("parent"), "r0", "c0")
        if open_rows <= OPEN_ROWS:
            raise_best(reached(rows.groupBy("feature", "parent", "value").agg(*sums), "value"))
            break
        counts = _histogram(rows)
    return spark.createDataFrame([(f, *totals[f], d) for f, d in best.items()], out_schema)


def ks_pvalue(d: Column, n_ref: Column, n_cur: Column, terms: int = 100) -> Column:
    """Two-sided asymptotic p-value: the Kolmogorov series, 1 where it does not converge."""
    n, m = n_ref.cast("double"), n_cur.cast("double")
    lam = d * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def exact_ks_pvalue(d: float, n: int, m: int) -> float:
    """Chance of a gap of `d` or more between two samples of one continuous distribution.

    The merged samples are a path from (0, 0) to (n, m); the gap stays below d while |i m - j n| < d n m. The share of
    such paths among all that lead to a point follows from its two neighbours, diagonal by diagonal inside the band,
    so no number leaves [0, 1]. Takes n + m steps over the width of the band.
    """
    reach = round(d * n * m)
    if reach <= 0:
        return 1.0
    inside = np.zeros(n + 2)
    inside[0] = 1.0  # entry i: paths with i steps of the first sample; the last entry stays 0
    for s in range(1, n + m + 1):
        low = max(0, s - m, (s * n - reach) // (n + m) + 1)
        high = min(n, s, -((-s * n - reach) // (n + m)) - 1)
        if low > high:
            return 1.0
        i = np.arange(low, high + 1)
        share = (inside[i - 1] * i + inside[i] * (s - i)) / s
        inside[max(0, low - 1) : high + 2] = 0.0
        inside[low : high + 1] = share
    return float(min(1.0, max(0.0, 1.0 - inside[n])))


@F.pandas_udf(T.DoubleType())
def _exact_pvalues(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([exact_ks_pvalue(*row) for row in zip(d, n.astype(int), m.astype(int))], dtype="float64")


P_METHODS = {"asymptotic": ks_pvalue, "exact": _exact_pvalues}


# ---------------------------------------------------------------------------------------------
# both


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str] | None = None,
    ks_alpha: float = 0.05,
    psi_threshold: float = 0.1,
    profile: PsiProfile | None = None,
    p_method: str = "asymptotic",
) -> DataFrame:
    """One row per feature that both tables have with values. Flags use unrounded numbers.

    A `profile` fitted earlier saves the reference's passes for PSI. With `p_method="exact"` the p-value of KS counts
    all orders of the two samples, in time that grows with their sizes' product times the gap; for up to some ten
    thousand rows it tells small samples right where the asymptotic one doesn't.
    """
    ks = ks_statistic(reference, current, features)
    psi = compute_psi(profile or reference, current, shared_features(reference, current, features)[1])
    return drift_flags(ks, psi, ks_alpha, psi_threshold, p_method)


def drift_flags(ks: DataFrame, psi: DataFrame, ks_alpha: float, psi_threshold: float, p_method: str) -> DataFrame:
    """The findings from both statistics, one row per feature."""
    if p_method not in P_METHODS:
        raise ValueError(f"p_method must be one of {sorted(P_METHODS)}, got '{p_method}'")
    p = P_METHODS[p_method](F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    joined = psi.join(F.broadcast(ks.withColumn("p", p)), "feature")
    ks_flag, psi_flag = F.col("p") < ks_alpha, F.col("psi") >= psi_threshold
    return joined.select(
        "feature",
        F.round("ks_statistic", 6).alias("ks_statistic"),
        F.round("p", 6).alias("ks_pvalue"),
        ks_flag.alias("ks_drift_detected"),
        F.round("psi", 6).alias("psi"),
        psi_flag.alias("psi_drift_detected"),
        psi_band("psi").alias("psi_band"),
        (ks_flag | psi_flag).alias("drift_detected"),
    )


def drift_summary(results: DataFrame, requested: Sequence[str]) -> DataFrame:
    """The drifted features, sorted, and their share of all requested ones."""
    drifted = F.col("drift_detected")
    names = F.array_sort(F.collect_list(F.when(drifted, F.col("feature"))))  # one name per feature
    return results.agg(
        F.count_if(drifted).alias("n_drifted"),
        F.lit(len(requested)).cast("long").alias("n_requested"),
        (F.count_if(drifted) / F.lit(max(len(requested), 1))).alias("drift_ratio"),
        names.alias("drifted_features"),
    )
