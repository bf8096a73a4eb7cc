import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from wardenlake.functions import order_stats
from wardenlake.functions.hashing import hash_key
from wardenlake.functions.order_stats import exact_quantiles, key_cutoffs, range_edges, running_totals

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = exact_quantiles(df, ["x"], PROBS)[None, "x"]
    np.testing.assert_allclose(got, np.percentile(values, [100 * p for p in PROBS]), rtol=1e-12, atol=1e-300)


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).normal(size=5000),
        np.random.default_rng(2).exponential(50, 3000) ** 3,
        np.random.default_rng(3).normal(1e9, 1e-3, 4000),  # one log bucket, many values
        np.r_[np.zeros(1000), np.random.default_rng(4).normal(size=2000)],
        np.r_[[-1e300, 1e300, 1e-300, -1e-300], np.arange(10.0)],
        np.repeat([3.5], 100),
        [7.0],
        np.arange(0, 1, 1e-4),
    ],
)
@pytest.mark.parametrize("leaf", [1, 1_000_000])
def test_quantiles_equal_numpy(spark, monkeypatch, values, leaf):
    monkeypatch.setattr(order_stats, "LEAF_ROWS", leaf)
    check(spark, values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_subnormal=False), min_size=1, max_size=60))
def test_quantiles_on_any_values(spark, values):
    check(spark, values)


def test_quantiles_by_group_and_column(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i % 3), float(a), float(b) if i % 7 else None) for i, (a, b) in enumerate(rng.normal(size=(2000, 2)))]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(5)
    got = exact_quantiles(df, ["a", "b"], [0.3, 0.5], by="g")
    for g in range(3):
        for j, c in enumerate("ab"):
            have = [r[1 + j] for r in rows if r[0] == g and r[1 + j] is not None]
            np.testing.assert_allclose(got[g, c], np.percentile(have, [30, 50]))


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, math.nan)], "a double, b double")
    got = exact_quantiles(df, ["a", "b"], [0.5])
    assert (None, "a") not in got and got[None, "b"] == [1.0]


@pytest.mark.parametrize("leaf", [1, 1000])
def test_cutoffs_are_the_keys_at_the_ranks(spark, monkeypatch, leaf):
    monkeypatch.setattr(order_stats, "LEAF_KEYS", leaf)
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), hash_key("id", 1).alias("k"))
    ranks = [lambda n: F.lit(0), lambda n: F.lit(1), lambda n: F.floor(n / 3), lambda n: n]
    got = key_cutoffs(df, F.col("k"), ranks, by=F.col("g"))
    for g in (0, 1):
        keys = sorted(r["k"] for r in df.where(F.col("g") == g).collect())
        assert got[g] == [None, keys[0], keys[len(keys) // 3 - 1], keys[-1]]


def test_cutoffs_need_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "LEAF_KEYS", 1)
    # keys that differ late only
    df = spark.range(500).select(F.concat(F.lit("0" * 10), F.substring(F.md5(F.col("id").cast("string")), 1, 22)).alias("k"))
    keys = sorted(r["k"] for r in df.collect())
    assert key_cutoffs(df, F.col("k"), [lambda n: F.lit(123)])[0] == [keys[122]]


@pytest.mark.parametrize("descending", [True, False])
def test_running_totals_do_not_depend_on_ranges(spark, descending):
    df = spark.range(2000).select((F.hash("id") / 1e6).alias("s"), (F.col("id") % 5).alias("m")).repartition(7)
    points = df.groupBy("s").agg(F.sum("m").alias("m"))
    edges = range_edges(df, "s", 100)
    assert len(edges) > 10
    one = running_totals(points, "s", ["m"], [], descending).orderBy("s").collect()
    many = running_totals(points, "s", ["m"], edges, descending).orderBy("s").collect()
    assert one == many
    total = sum(r["m"] for r in one)
    assert (one[0] if descending else one[-1])["m_upto"] == total


def test_few_values_need_no_ranges(spark):
    assert range_edges(spark.range(1000).select((F.col("id") % 10).cast("double").alias("s")), "s", 1000) == []
