"""The reference side of a drift check on disk, written once, so that checks need not read the reference again.

Tables below one folder:

* `cells`: rows, smallest and largest value of every 1/32 octave of a feature, a bounded number.
* `values`: how often each value of a feature occurs, in folders of one feature and octave, sorted by value.
* `features`: the profiled columns.
* `bins`: edges and counts of PSI. It is written last: a folder without it is no profile.

A check compares the two histograms first. The largest gap of the distribution functions can only hide in few cells; of
`values` Spark reads the folders of those cells and no others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardenlake.functions.order_stats import log_bucket, long_form
from wardenlake.functions.storage import materialize
from wardenlake.operators.drift import PsiProfile, compute_psi, drift_flags, fit_psi, largest_gaps
from wardenlake.schema import KEY, numeric_columns

CELLS_PER_OCTAVE = 32
CELLS, VALUES, BINS = "cells", "values", "bins"
FEATURE, OCTAVE = "of_feature", "octave"  # folder names, apart from the columns of the rows


@dataclass(frozen=True)
class ReferenceProfile:
    spark: SparkSession
    path: str

    def psi(self) -> PsiProfile:
        rows = self.spark.read.parquet(f"{self.path}/{BINS}").collect()  # two rows per bin and feature
        edges, counts = {}, {}
        for r in rows:
            if r["edge"] is not None:
                edges.setdefault(r["feature"], []).append(r["edge"])
            else:
                counts[r["feature"], r["bin"]] = r["n"]
        return PsiProfile({f: sorted(e) for f, e in edges.items()}, counts)

    def features(self) -> list[str]:
        """The profiled columns, those without any value included."""
        return [r["feature"] for r in self.spark.read.parquet(f"{self.path}/features").orderBy("place").collect()]  # a row each

    def cells(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{CELLS}")

    def values(self, wanted: DataFrame | None = None) -> DataFrame:
        """(feature, value, n), of the octaves that `wanted` (feature, b) names, or of all."""
        rows = self.spark.read.schema(f"feature string, value double, n long, {FEATURE} string, {OCTAVE} long").parquet(f"{self.path}/{VALUES}")
        if wanted is not None:
            octaves: dict[str, list[int]] = {}
            for r in wanted.select("feature", octave(F.col("b")).alias(OCTAVE)).distinct().collect():  # at most 4,200 a feature
                octaves.setdefault(r["feature"], []).append(r[OCTAVE])
            within = F.lit(False)
            for feature, numbers in sorted(octaves.items()):
                within |= (F.col(FEATURE) == folder_name(feature)) & F.col(OCTAVE).isin(sorted(numbers))
            rows = rows.where(within)
        return rows.select("feature", "value", "n")


def octave(b: Column) -> Column:
    return F.floor(b / CELLS_PER_OCTAVE).cast("long")


def folder_name(feature: str) -> str:
    """Feature names that differ in case only would share a folder on some file systems."""
    return feature.encode().hex()


def write_profile(reference: DataFrame, path: str, features: Sequence[str] | None = None, n_bins: int = 10) -> ReferenceProfile:
    """Profile the numeric columns of `reference`, or the given ones. What a broken attempt left at the path is replaced.

    Missing values (NULL, NaN) have no part in it. A whole profile is never changed: a new reference gets a new path.
    """
    spark = reference.sparkSession
    if open_profile(spark, path):
        raise FileExistsError(f"there is a profile at {path}")
    columns = list(features) if features is not None else numeric_columns(reference, exclude=(KEY,))
    if not columns:
        raise ValueError("a profile needs at least one numeric column")
    counted = long_form(reference, columns).groupBy("feature", "value").agg(F.count("*").alias("n"))
    placed = counted.withColumns({"b": log_bucket(F.col("value")), FEATURE: F.lower(F.hex(F.encode("feature", "UTF-8")))})
    placed = placed.withColumn(OCTAVE, octave(F.col("b")))
    order = [FEATURE, OCTAVE, "value"]
    placed.repartitionByRange(*order).sortWithinPartitions(*order).drop("b").write.mode("overwrite").partitionBy(FEATURE, OCTAVE).parquet(f"{path}/{VALUES}")
    profile = ReferenceProfile(spark, path)
    cells = profile.values().withColumn("b", log_bucket(F.col("value"))).groupBy("feature", "b")
    cells = cells.agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    cells.write.mode("overwrite").parquet(f"{path}/{CELLS}")
    spark.createDataFrame(list(enumerate(columns)), "place int, feature string").write.mode("overwrite").parquet(f"{path}/features")
    psi = fit_psi(reference, columns, n_bins)
    edges = [(f, None, e, None) for f, cuts in psi.edges.items() for e in cuts]
    counts = [(f, b, None, n) for (f, b), n in psi.counts.items()]
    spark.createDataFrame([*edges, *counts], "feature string, bin int, edge double, n long").write.mode("overwrite").parquet(f"{path}/{BINS}")
    return profile


def open_profile(spark: SparkSession, path: str) -> ReferenceProfile | None:
    """The profile at the path, or None if there is no whole one."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BINS}/_SUCCESS")
    whole = done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
    return ReferenceProfile(spark, path) if whole else None


def ks_against_profile(profile: ReferenceProfile, current: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """What `ks_statistic(reference, current)` returns, without reading more of the reference than undecided octaves."""
    known = profile.features()
    columns = [c for c in (known if features is None else features) if c in known and c in current.columns]
    if not columns:
        return current.sparkSession.createDataFrame([], "feature string, n_ref long, n_cur long, ks_statistic double")
    zero = F.lit(0).cast("long")
    start = {"parent": zero, "b": log_bucket(F.col("value"))}
    mine = long_form(current, columns).withColumns({"r": zero, "c": F.lit(1).cast("long"), **start})
    own = mine.groupBy("feature", "parent", "b").agg(
        F.sum("r").alias("r"), F.sum("c").alias("c"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    theirs = profile.cells().where(F.col("feature").isin(columns))
    theirs = theirs.select("feature", zero.alias("parent"), "b", F.col("n").alias("r"), zero.alias("c"), "lo", "hi")
    both = own.unionByName(theirs).groupBy("feature", "parent", "b")
    counts = both.agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def rows_of(undecided: DataFrame) -> DataFrame:
        reference = profile.values(undecided).select("feature", "value", F.col("n").alias("r"), zero.alias("c"))
        return mine.unionByName(reference.withColumns(start))

    return largest_gaps(materialize(counts), rows_of)


def detect_drift_from_profile(
    profile: ReferenceProfile,
    current: DataFrame,
    features: Sequence[str] | None = None,
    ks_alpha: float = 0.05,
    psi_threshold: float = 0.1,
    p_method: str = "asymptotic",
    psi: PsiProfile | None = None,
) -> DataFrame:
    """What `detect_drift` returns for the profiled reference. `psi`, read earlier, saves a read of the bins."""
    known = profile.features()
    columns = [c for c in (known if features is None else features) if c in known]
    ks = ks_against_profile(profile, current, columns)
    return drift_flags(ks, compute_psi(psi or profile.psi(), current, columns), ks_alpha, psi_threshold, p_method)
