import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import scored
from wardenlake.operators import cost, metrics, thresholds


def areas(labels, scores):
    """ROC and PR area by walking down the distinct scores."""
    labels, scores = np.array(labels), np.array(scores)
    p, n = (labels == 1).sum(), (labels == 0).sum()
    tp = fp = roc = pr = 0.0
    last = 1.0
    for s in sorted(set(scores), reverse=True):
        a, b = ((scores == s) & (labels == 1)).sum(), ((scores == s) & (labels == 0)).sum()
        roc += b * (2 * tp + a) / 2
        precision = (tp + a) / (tp + a + fp + b)
        pr += a * (precision + last) / 2
        tp, fp, last = tp + a, fp + b, precision
    return roc / (p * n), pr / p


def test_pr_area_starts_at_precision_one(spark):
    df = scored(spark, [1, 0, 1, 0], [0.9, 0.9, 0.4, 0.2])
    assert metrics.pr_auc(df).first()[0] == pytest.approx(0.666667, abs=1e-6)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 20])
def test_areas_with_ties_and_ranges(spark, rows_per_range):
    rng = np.random.default_rng(0)
    labels = (rng.random(900) < 0.1).astype(int)
    scores = np.round(0.6 * rng.random(900) + 0.3 * labels, 3)
    got = metrics.curve_areas(scored(spark, labels, scores), rows_per_range=rows_per_range).first()
    assert tuple(got) == pytest.approx(areas(labels, scores))


def test_a_third_of_the_rows_share_one_score(spark):
    rng = np.random.default_rng(1)
    labels = (rng.random(600) < 0.2).astype(int)
    scores = np.where(np.arange(600) < 200, 0.0, rng.random(600))
    got = metrics.curve_areas(scored(spark, labels, scores), rows_per_range=50).first()
    assert tuple(got) == pytest.approx(areas(labels, scores))


def test_one_class(spark):
    row = metrics.calculate_metrics(scored(spark, [0, 0, 0], [0.1, 0.2, 0.9])).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None
    assert (row["precision"], row["recall"], row["f1"], row["mcc"]) == (0.0, 0.0, 0.0, 0.0)
    assert row["accuracy"] == pytest.approx(2 / 3)


def test_empty_table(spark):
    df = scored(spark, [0], [0.1]).where("tx_id < 0")
    row = metrics.calculate_metrics(df).first()
    assert row["accuracy"] == 0.0 and row["roc_auc"] is None
    assert thresholds.threshold_curve(df).agg(F.sum("tp"), F.sum("tn")).first()[:] == (0, 0)


def test_published_confusion_matrices(spark):
    counts = spark.createDataFrame([("lr", 4, 0, 1, 2995), ("rf", 1, 0, 4, 2995)], "model string, tp long, fp long, fn long, tn long")
    got = {r["model"]: r for r in metrics.rates(counts).collect()}
    rounded = lambda r: [round(r[m], 4) for m in ("accuracy", "precision", "recall", "f1", "mcc")]
    assert rounded(got["lr"]) == [0.9997, 1.0, 0.8, 0.8889, 0.8943]
    assert rounded(got["rf"]) == [0.9987, 1.0, 0.2, 0.3333, 0.4469]


def test_mcc_of_huge_counts(spark):
    n = 4 * 10**11
    counts = spark.createDataFrame([(n, n, n, n)], "tp long, fp long, fn long, tn long")
    assert metrics.rates(counts).first()["mcc"] == 0.0


def test_cost_of_the_published_matrix(spark):
    df = scored(spark, [1] * 5 + [0] * 20, [0.9] * 4 + [0.1] * 21)
    row = cost.compute_financial_cost(df).first()
    assert (row["fn_cost_usd"], row["tp_savings_usd"], row["net_benefit_usd"]) == (91.66, 122.21, 30.55)


def brute(labels, scores, t):
    p = scores >= t
    return [int((p & (labels == 1)).sum()), int((p & (labels == 0)).sum()), int((~p & (labels == 1)).sum()), int((~p & (labels == 0)).sum())]


def test_every_threshold(spark):
    rng = np.random.default_rng(2)
    labels = (rng.random(500) < 0.1).astype(int)
    scores = np.r_[rng.random(300), np.linspace(0.01, 0.99, 200)]  # scores that equal thresholds
    got = {r["threshold"]: r for r in thresholds.threshold_curve(scored(spark, labels, scores)).collect()}
    grid = np.linspace(0.01, 0.99, 200)
    assert sorted(got) == pytest.approx(grid)
    for t in got:
        assert [got[t][c] for c in ("tp", "fp", "fn", "tn")] == brute(labels, scores, t)


def test_the_lowest_threshold_wins_a_tie(spark):
    df = scored(spark, [1, 0], [0.8, 0.2])
    row = thresholds.find_optimal_threshold(df, thresholds=[0.5, 0.3, 0.7]).first()
    assert row["optimal_threshold"] == 0.3 and row["best_score"] == 1.0


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="f1"):
        thresholds.find_optimal_threshold(scored(spark, [1], [0.5]), metric="auc")


def test_grid_is_the_even_grid():
    np.testing.assert_allclose(thresholds.default_thresholds(), np.linspace(0.01, 0.99, 200), rtol=1e-15)


def test_model_comparison(spark):
    rows = spark.createDataFrame([("a", 0.5, 0.1), ("b", 0.7, 0.2)], "model string, f1 double, mcc double")
    got = {r["metric"]: (r["a"], r["b"]) for r in metrics.compare_models(rows, ["a", "b"]).collect()}
    assert got == {"f1": (0.5, 0.7), "mcc": (0.1, 0.2)}


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_rows_without_a_score_rank_last_whatever_the_size(spark, missing):
    rows = [(i, i % 3 == 0, None if i in (6, 20) else (i * 7 % 40) / 40) for i in range(40)]
    df = spark.createDataFrame([(i, int(y), missing if s is None else s) for i, y, s in rows], "tx_id long, Class int, score double")
    filled = spark.createDataFrame([(i, int(y), -1.0 if s is None else s) for i, y, s in rows], "tx_id long, Class int, score double")
    want = metrics.curve_areas(filled).first()
    for rows_per_range in (5, 1_000_000):
        got = metrics.curve_areas(df, rows_per_range=rows_per_range).first()
        assert (got["roc_auc"], got["pr_auc"]) == pytest.approx((want["roc_auc"], want["pr_auc"]))
        points = metrics.roc_curve(df, rows_per_range=rows_per_range)
        assert points.count() == 40 and points.where("threshold = double('-Infinity') AND tpr = 1 AND fpr = 1").count() == 1
    counts = thresholds.threshold_counts(df).collect()
    assert [tuple(r) for r in counts] == [tuple(r) for r in thresholds.threshold_counts(filled).collect()]
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 40 for r in counts)
