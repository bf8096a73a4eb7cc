"""Exact order statistics and running totals that never sort a table in one task.

* `exact_quantiles` narrows every requested rank down through histograms of ever finer buckets.
  A pass is one map-side aggregation; the driver sees only the buckets that hold a wanted rank.
* `key_cutoffs` does the same on hash keys, so "the first n rows in random order" becomes a
  comparison with a constant.
* `running_totals` accumulates along a sorted key in balanced ranges plus range offsets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SLICES = 4096
LEAF_KEYS = 1000
LEAF_ROWS = 1_000_000
PROBE_ROWS = 1_000_000
MAX_RANGES = 20_000


# ---------------------------------------------------------------------------------------------
# buckets of values


def log_bucket(value: Column) -> Column:
    """A bucket number that grows with the value; a bucket spans 1/32 of an octave.

    Any DOUBLE falls in one of about 134,000 buckets, so a histogram over it is bounded.
    """
    magnitude = F.floor((F.log2(F.abs(value)) + 1100.0) * 32.0)
    return F.when(value == 0.0, F.lit(0)).when(value > 0.0, magnitude).otherwise(-magnitude).cast("long")


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key, feature and non-missing value."""
    doubles = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keys), list(columns), "feature", "value").where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def zoom(rows: DataFrame, brackets: DataFrame, on: Sequence[str], slices: int = SLICES) -> DataFrame:
    """Keep the rows inside a bracket and cut every bracket into equal slices.

    `brackets` has the columns `on` (the bucket's name), `next` (its new number), `lo` and `hi`.
    """
    share = (F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo"))
    kept = [c for c in rows.columns if c not in ("parent", "b")]
    return rows.join(brackets, list(on)).select(
        *kept,
        F.col("next").alias("parent"),
        F.least(F.floor(share * slices), F.lit(slices - 1)).cast("long").alias("b"),
    )


# ---------------------------------------------------------------------------------------------
# quantiles


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: str | None = None
) -> dict[tuple, list[float]]:
    """Linearly interpolated quantiles, exact at any size.

    Returns `{(group, column): [one value per probability]}`, the group being None without `by`.
    A column without values has no entry. `by` must have few distinct values.
    """
    spark = df.sparkSession
    keys = [] if by is None else [by]
    ids = [*keys, "feature"]
    name = [*ids, "parent", "b"]
    rows = long_form(df, columns, keys).withColumns(
        {"parent": F.lit(0).cast("long"), "b": log_bucket(F.col("value"))}
    )

    def histogram(rows, within, bucket="b"):
        order = Window.partitionBy(*within).orderBy(bucket)
        counts = rows.groupBy(*ids, "parent", bucket).agg(
            F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        return counts.withColumn("before", F.sum("n").over(order) - F.col("n"))

    # positions, from 0, of the two neighbours of every quantile
    wanted = [
        side(F.lit(float(p)) * (F.col("total") - 1)).cast("long") for p in probs for side in (F.floor, F.ceil)
    ]
    hits = (
        histogram(rows, ids)
        .withColumn("total", F.sum("n").over(Window.partitionBy(*ids)))
        .select("*", F.posexplode(F.array(*wanted)).alias("slot", "rank"))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
        .collect()
    )

    totals, found = {}, {}
    for hit in hits:
        totals[(hit[by] if by else None, hit["feature"])] = hit["total"]

    while hits:
        brackets, targets = {}, []
        for hit in hits:
            group = hit[by] if by else None
            local = hit["rank"] - hit["before"]
            if hit["lo"] == hit["hi"] or local == 0:
                found[group, hit["feature"], hit["slot"]] = hit["lo"]
            elif local == hit["n"] - 1:
                found[group, hit["feature"], hit["slot"]] = hit["hi"]
            else:
                bucket = tuple(hit[c] for c in name)
                number, *_ = brackets.setdefault(bucket, (len(brackets) + 1, hit["lo"], hit["hi"]))
                targets.append((number, hit["slot"], local))
        if not targets:
            break
        group_field = [T.StructField(by, df.schema[by].dataType)] if by else []
        bracket_schema = T.StructType(
            group_field
            + [T.StructField("feature", T.StringType())]
            + [T.StructField(c, T.LongType()) for c in ("parent", "b", "next")]
            + [T.StructField(c, T.DoubleType()) for c in ("lo", "hi")]
        )
        # at most two brackets per column, group and probability
        small = spark.createDataFrame([(*k, *v) for k, v in brackets.items()], bracket_schema)
        rows = zoom(rows, F.broadcast(small), name)
        wishes = spark.createDataFrame(targets, "parent long, slot int, rank long")
        if max(hit["n"] for hit in hits) <= LEAF_ROWS:
            # few enough to put a bracket's values themselves in order
            counted = histogram(rows, ["parent"], "value")
        else:
            counted = histogram(rows, ["parent"])
        hits = (
            counted
            .join(F.broadcast(wishes), "parent")
            .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n")))
            .collect()
        )

    result = {}
    for (group, feature), total in totals.items():
        values = []
        for i, p in enumerate(probs):
            low, high = found[group, feature, 2 * i], found[group, feature, 2 * i + 1]
            share = float(p) * (total - 1) - math.floor(float(p) * (total - 1))
            values.append(low if low == high else low + (high - low) * share)
        result[group, feature] = values
    return result


# ---------------------------------------------------------------------------------------------
# ranks of hash keys


def key_cutoffs(
    rows: DataFrame, key: Column, ranks: Sequence[Callable[[Column], Column]], by: Column | None = None
) -> dict:
    """The keys at given ranks of every group, without ranking the rows.

    `key` is a column of evenly spread hex strings. Every entry of `ranks` turns the size of a
    group into a rank counted from 1; rank 0 has no key. Returns `{group: [key or None, ...]}`.
    """
    group = F.lit(0) if by is None else by
    base = rows.select(group.alias("g"), key.alias("k"))
    digits = 4
    prefix = F.substring("k", 1, digits)
    order = Window.partitionBy("g").orderBy("p")  # at most 65,536 rows in a group
    hist = (
        base.groupBy("g", prefix.alias("p"))
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "before": F.sum("n").over(order) - F.col("n"),
                "total": F.sum("n").over(Window.partitionBy("g")),
            }
        )
    )
    wishes = F.array(*[r(F.col("total")).cast("long") for r in ranks])
    first = hist.select("*", F.posexplode(wishes).alias("slot", "rank")).where(
        ((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n")))
        | ((F.col("rank") == 0) & (F.col("before") == 0))
    )
    found: dict = {}
    pending = []
    for h in first.collect():
        found.setdefault(h["g"], [None] * len(ranks))
        if h["rank"] > 0:
            pending.append((h["g"], h["p"], h["slot"], h["rank"] - h["before"], h["n"]))

    spark = rows.sparkSession
    schema = T.StructType(
        [
            T.StructField("g", base.schema["g"].dataType),
            T.StructField("p", T.StringType()),
            T.StructField("slot", T.IntegerType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    while pending and max(p[4] for p in pending) > LEAF_KEYS and digits < 32:
        wide = spark.createDataFrame([p[:4] for p in pending], schema)  # one row per wish
        heads = wide.select("g", "p").distinct()
        inside = base.withColumn("p", F.substring("k", 1, digits)).join(F.broadcast(heads), ["g", "p"])
        digits += 4
        order = Window.partitionBy("g", "p").orderBy("q")
        hist = (
            inside.groupBy("g", "p", F.substring("k", 1, digits).alias("q"))
            .agg(F.count("*").alias("n"))
            .withColumn("before", F.sum("n").over(order) - F.col("n"))
        )
        hits = hist.join(F.broadcast(wide), ["g", "p"]).where(
            (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("n"))
        )
        pending = [(h["g"], h["q"], h["slot"], h["rank"] - h["before"], h["n"]) for h in hits.collect()]

    if pending:
        wide = spark.createDataFrame([p[:4] for p in pending], schema)
        heads = wide.select("g", "p").distinct()
        leaf = base.withColumn("p", F.substring("k", 1, digits)).join(F.broadcast(heads), ["g", "p"])
        placed = leaf.withColumn("at", F.row_number().over(Window.partitionBy("g", "p").orderBy("k")))
        hits = placed.join(F.broadcast(wide), ["g", "p"]).where(F.col("at") == F.col("rank"))
        for h in hits.select("g", "slot", "k").collect():
            found[h["g"]][h["slot"]] = h["k"]
    return found


# ---------------------------------------------------------------------------------------------
# running totals


def range_edges(rows: DataFrame, key: str, rows_per_range: int) -> list[float]:
    """Cut points that split the distinct values of `key` into ranges of about equal size.

    They only balance the work: any cut points give the same totals. They come from the values
    whose hash falls in one residue class, so ties count once.
    """
    distinct = rows.agg(F.approx_count_distinct(key)).first()[0]
    parts = min(MAX_RANGES, math.ceil(distinct / rows_per_range))
    if parts < 2:
        return []
    step = max(1, distinct // PROBE_ROWS)
    probe = rows.select(key).where(F.pmod(F.xxhash64(key), F.lit(step)) == 0).distinct()
    cuts = probe.approxQuantile(key, [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted({c for c in cuts if math.isfinite(c)})


def running_totals(
    points: DataFrame, key: str, measures: Sequence[str], edges: Sequence[float], descending: bool = True
) -> DataFrame:
    """Add `<measure>_upto`, the inclusive running total along `key`, which must be unique."""
    towards = F.desc if descending else F.asc
    if edges:
        cut = Bucketizer(
            splits=[-math.inf, *edges, math.inf], inputCol=key, outputCol="range_no", handleInvalid="error"
        )
        placed = cut.transform(points)
    else:
        placed = points.withColumn("range_no", F.lit(0.0))
    inside = Window.partitionBy("range_no").orderBy(towards(key)).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumns({f"{m}_upto": F.sum(m).over(inside) for m in measures})
    if edges:
        ahead_of = Window.orderBy(towards("range_no")).rowsBetween(Window.unboundedPreceding, -1)
        ahead = (
            placed.groupBy("range_no")
            .agg(*[F.sum(m).alias(m) for m in measures])
            .select("range_no", *[F.coalesce(F.sum(m).over(ahead_of), F.lit(0)).alias(f"{m}_ahead") for m in measures])
        )
        # one row per range, at most MAX_RANGES + 1
        out = out.join(F.broadcast(ahead), "range_no").withColumns(
            {f"{m}_upto": F.col(f"{m}_upto") + F.col(f"{m}_ahead") for m in measures}
        )
    return out.select(*points.columns, *[f"{m}_upto" for m in measures])
