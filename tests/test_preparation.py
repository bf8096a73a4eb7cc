import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wardenlake.models.stages import ScaledAssembler
from wardenlake.models.training import get_preprocessor
from wardenlake.operators import features, profile, projections, sampling
from wardenlake.schema import FEATURES, SchemaError, nan_to_null, numeric_columns


def transactions(spark, n, positives):
    return spark.range(n).select(
        F.col("id").alias("tx_id"),
        (F.col("id") * 3.0).alias("Time"),
        F.sin("id").alias("V1"),
        F.abs(F.cos("id") * 100).alias("Amount"),
        (F.col("id") < positives).cast("int").alias("Class"),
    )


def test_cap_of_the_outlier_vector(spark):
    df = spark.createDataFrame([(1.0,)] * 999 + [(10000.0,)], "Amount double")
    assert features.upper_caps(df)["Amount"] == pytest.approx(10.999)
    assert features.winsorize(df).agg(F.max("Amount")).first()[0] == pytest.approx(10.999)
    assert features.outlier_counts(df, features.upper_caps(df)).first()[0] == 1


def test_capping_passes_over_absent_columns_and_gaps(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "Amount double")
    got = features.winsorize(df, ["Amount", "Other"], 0.5).collect()
    assert [r["Amount"] for r in got] == [1.0, None, 2.0]


def test_imputation_takes_the_mean_of_the_middle_two(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 2), (2.0, 3), (3.0, 4), (10.0, 5)], "a double, tx_id long")
    assert features.impute_median(df).where("tx_id = 2").first()["a"] == 2.5
    full = df.where("a IS NOT NULL")
    assert features.impute_median(full) is full


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "a double"))
    assert profile.null_total(df).first()[0] == 1


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "Time double, Amount double")
    got = sorted(tuple(r) for r in features.standard_scale(df).collect())
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_scaled_columns_come_first_and_others_stay_as_they_are(spark):
    df = transactions(spark, 500, 25)
    assembler = get_preprocessor(df)
    assert assembler.features_names() == ["Time", "Amount", "V1"]
    out = assembler.fit(df).transform(df).withColumn("x", vector_to_array("features"))
    assert out.where(F.col("x")[2] != F.col("V1")).count() == 0
    assert out.agg(F.max(F.size("x"))).first()[0] == 3


def test_preparation_is_fitted_on_training_rows_only(spark):
    train = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0)], "Time double, Amount double")
    model = ScaledAssembler(scaledCols=["Time", "Amount"], restCols=[], cappedCols=["Amount"], quantile=1.0).fit(train)
    test = spark.createDataFrame([(0.0, 100.0), (0.0, None)], "Time double, Amount double")
    got = [r[0] for r in model.transform(test).select(vector_to_array("features")).collect()]
    assert got[0][1] == pytest.approx(1.0)  # capped at 3
    assert got[1][1] == pytest.approx(0.0)  # the median, 2


def test_split_sizes(spark):
    split = sampling.stratified_split(transactions(spark, 1000, 20))
    got = {r["split"]: (r["n"], r["f"]) for r in split.groupBy("split").agg(F.count("*").alias("n"), F.sum("Class").alias("f")).collect()}
    assert got == {"train": (800, 16), "test": (200, 4)}


def test_split_does_not_depend_on_partitions(spark):
    df = transactions(spark, 700, 30)
    a = {r["tx_id"] for r in sampling.stratified_split(df.repartition(1)).where("split = 'test'").collect()}
    b = {r["tx_id"] for r in sampling.stratified_split(df.repartition(8, "V1")).where("split = 'test'").collect()}
    assert a == b and len(a) == 140


def test_split_needs_its_target(spark):
    with pytest.raises(SchemaError, match="missing"):
        sampling.stratified_split(spark.range(3).withColumnRenamed("id", "tx_id"))


def test_fold_sizes_differ_by_one_at_most(spark):
    folds = sampling.stratified_folds(transactions(spark, 1003, 23), 5)
    sizes = {}
    for r in folds.groupBy("Class", "fold").count().collect():
        sizes.setdefault(r["Class"], []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


def test_fewer_rows_than_folds(spark):
    folds = sampling.stratified_folds(transactions(spark, 40, 3), 5)
    assert sorted(r["fold"] for r in folds.where("Class = 1").collect()) == [0, 1, 2]


@pytest.mark.parametrize("n, expected", [(0, 0), (17, 17), (5000, 300)])
def test_sample_size(spark, n, expected):
    assert sampling.seeded_sample(transactions(spark, 300, 10), n).count() == expected


def test_empty_table(spark):
    df = transactions(spark, 0, 0)
    assert sampling.stratified_split(df).count() == 0
    assert sampling.seeded_sample(df, 5).count() == 0
    assert profile.fraud_share(df).first()["fraud_pct"] == 0.0
    assert features.impute_median(df).count() == 0


def test_class_weights(spark):
    got = {r["Class"]: r["weight"] for r in sampling.class_weights(transactions(spark, 100, 10)).collect()}
    assert got == {0: pytest.approx(100 / 180), 1: pytest.approx(5.0)}


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2.0, 9.0, 1)], "tx_id long, V3 double, extra double, Class int")
    out = projections.align_schema(df)
    assert out.columns == ["tx_id", *FEATURES]
    row = out.first()
    assert row["V3"] == 2.0 and row["Time"] == 0.0


def test_numeric_columns_are_the_default_features(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 1)], "tx_id long, a double, s string, Class int")
    assert numeric_columns(df) == ["a", "Class"]


@pytest.mark.parametrize("bad", [0.0, 1.0, -1, 2])
def test_threshold_range(bad):
    with pytest.raises(ValueError):
        projections.apply_threshold("score", bad)


def test_a_score_of_one_half(spark):
    df = spark.createDataFrame([(0.5,)], "score double")
    row = df.select(projections.argmax_prediction("score").alias("a"), projections.apply_threshold("score", 0.5).alias("t")).first()
    assert (row["a"], row["t"]) == (0, 1)


def test_correlation_skips_gaps_pairwise(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, None, 5.0), (3.0, 1.0, 5.0), (4.0, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 1, 7])[0, 1])
    assert got["a", "a"] == 1.0 and got["a", "c"] is None and got["c", "c"] is None


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(300 + 10 * (i % 7)), 0) for i in range(200)], "Amount double, Class int")
    grid = profile.amount_density(df)
    assert grid.agg(F.sum("density")).first()[0] * 1000 / 199 == pytest.approx(1.0, abs=1e-3)


def test_correlations_of_many_columns_with_gaps_take_two_jobs(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 12)) @ rng.standard_normal((12, 12)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 5.0
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names))
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df.repartition(5)).collect()}
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            want = None if 3 in (i, j) else pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
            assert got[a, b] == want
    alone = spark.createDataFrame([(1.0, None), (2.0, 3.0), (4.0, None)], "a double, b double")
    assert [r["corr"] for r in profile.correlation_matrix(alone).orderBy("col_a", "col_b").collect()] == [1.0, None, None, None]
    assert all(r["corr"] is None for r in profile.correlation_matrix(alone.limit(0)).collect())


def test_density_equals_the_sum_of_all_kernels(spark):
    rng = np.random.default_rng(4)
    amounts = {0: np.concatenate([rng.exponential(80, 3000), [0.0, 1000.0, 25_000.0]]), 1: rng.normal(400, 3, 500), 2: np.array([7.0]), 3: np.array([5.0, 5.0])}
    rows = [(int(c), float(v)) for c, x in amounts.items() for v in x] + [(0, None)]
    got = {}
    for r in profile.amount_density(spark.createDataFrame(rows, "Class int, Amount double").repartition(3)).collect():
        got.setdefault(r["Class"], {})[r["x"]] = r["density"]
    for c in (0, 1):
        x, n = amounts[c], len(amounts[c])
        width = x.std(ddof=1) * n**-0.2
        grid = np.arange(200) * (1000.0 / 199)
        want = np.exp(-0.5 * ((grid[:, None] - x) / width) ** 2).sum(axis=1) / (n * width * np.sqrt(2 * np.pi))
        assert len(got[c]) == 200
        np.testing.assert_allclose([got[c][g] for g in sorted(got[c])], want, atol=1e-13 / width)
    assert len(got[2]) == len(got[3]) == 200 and set(got[2].values()) == set(got[3].values()) == {None}
