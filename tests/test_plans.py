"""What the optimizer makes of the queries: nothing whole in one task, nothing read in vain."""

import re

import pytest
from pyspark.sql import Window, functions as F

from wardenlake.operators import metrics, sampling, smote
from wardenlake.operators.projections import filter_class
from wardenlake.plans.catalog import QUERIES
from wardenlake.plans.oracle import ORACLE
from wardenlake.sources import bindings
from wardenlake.sources.transactions import land_transactions

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["confusion_matrix", "binary_metrics", "flag_summary", "apply_threshold"])
def test_scans_read_only_what_they_need(spark, name):
    text = plan(QUERIES[name](spark, SF))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas and all("props" not in s and "ts:" not in s and "user_id" not in s for s in schemas)


def test_filters_reach_the_scan(spark, tmp_path):
    landed = land_transactions(bindings.transactions(spark, SF), str(tmp_path / "tx"))
    text = plan(filter_class(landed, 1).select("tx_id", "Amount"))
    assert "PushedFilters: [IsNotNull(Class), EqualTo(Class,1)]" in text
    assert "ReadSchema: struct<tx_id:bigint,Amount:double,Class:int>" in text


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("split", ["stratified_split", "stratified_folds", "seeded_sample"])
def test_assigning_rows_moves_none(spark, split):
    assert "Exchange" not in plan(getattr(sampling, split)(bindings.transactions(spark, SF).drop("Time"), *([50] if split == "seeded_sample" else [])))


def test_totals_along_scores_stay_in_ranges(spark):
    curve = metrics.curve_counts(bindings.scored_transactions(spark, SF), rows_per_range=50)
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan(curve))
    assert any("range_no" in w for w in windows)


def test_copies_are_limited_before_the_shuffle(spark):
    points = spark.range(100).select(F.col("id"), F.array(F.col("id") % 3).alias("x"))
    limited = points.withColumn("at", F.row_number().over(Window.partitionBy("x").orderBy("id"))).where("at <= 6")
    text = plan(limited)
    assert text.index("row_number(), 6, Final") < text.index("Exchange") < text.index("row_number(), 6, Partial")
    assert smote.BLOCK_ROWS * smote.BLOCK_ROWS * 8 < 64 << 20
