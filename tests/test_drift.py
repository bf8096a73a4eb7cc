import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardenlake.operators import drift


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def psi_of(ref, cur):
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, 11)))
    r = np.histogram(ref, edges)[0] / (len(ref) + 1e-8) + 1e-8
    c = np.histogram(cur, edges)[0] / (len(cur) + 1e-8) + 1e-8
    return float(np.sum((c - r) * np.log(c / r)))


def ks_of(ref, cur):
    at = np.unique(np.r_[ref, cur])
    share = lambda v: np.searchsorted(np.sort(v), at, side="right") / len(v)
    return float(np.abs(share(ref) - share(cur)).max())


RNG = np.random.default_rng(0)
PAIRS = {
    "same": (RNG.normal(size=3000), RNG.normal(size=2000)),
    "shifted": (RNG.normal(size=3000), RNG.normal(0.5, 1, 1000)),
    "disjoint": (RNG.random(500), RNG.random(400) + 5),
    "ties": (RNG.integers(0, 12, 800), RNG.integers(2, 14, 700)),
    "one log bucket": (RNG.normal(1e6, 1, 2000), RNG.normal(1e6, 1.2, 1500)),
    "hot value": (np.r_[np.zeros(700), RNG.normal(size=1400)], np.r_[np.zeros(300), RNG.normal(size=1500)]),
    "identical": (np.arange(100), np.arange(100)),
}


LIMITS = [(10**6, 10**4, 10**6), (20, 10**4, 10**6), (5, 0, 10**6), (5, 0, 0)]


@pytest.mark.parametrize(
    "name, open_rows, local, broadcast",
    [(name, *LIMITS[0]) for name in PAIRS] + [(n, *limit) for n in ("same", "one log bucket", "hot value") for limit in LIMITS[1:]],
)
def test_ks_equals_brute_force(spark, monkeypatch, name, open_rows, local, broadcast):
    monkeypatch.setattr(drift, "OPEN_ROWS", open_rows)
    monkeypatch.setattr(drift, "LOCAL_BUCKETS", local)
    monkeypatch.setattr(drift, "BROADCAST_BUCKETS", broadcast)
    ref, cur = PAIRS[name]
    row = drift.ks_statistic(frame(spark, a=ref), frame(spark, a=cur)).first()
    assert row["ks_statistic"] == pytest.approx(ks_of(ref, cur), abs=1e-12)
    assert (row["n_ref"], row["n_cur"]) == (len(ref), len(cur))


@pytest.mark.parametrize("name", PAIRS)
def test_psi_equals_numpy(spark, name):
    ref, cur = PAIRS[name]
    got = drift.compute_psi(frame(spark, a=ref), frame(spark, a=cur)).first()["psi"]
    assert got == pytest.approx(psi_of(ref, cur), abs=1e-9)


def test_constant_reference(spark):
    got = drift.compute_psi(frame(spark, a=[3, 3, 3]), frame(spark, a=[1, 3, 9])).first()
    assert got["psi"] == 0.0


def test_absent_and_empty_features_are_skipped(spark):
    ref = frame(spark, a=[1, 2, 3], b=[None, None, None], c=[1, 2, 3])
    cur = frame(spark, a=[1, 2, 4], b=[1, 2, 3], d=[1, 2, 3])
    requested = ["a", "b", "c", "d"]
    found = drift.detect_drift(ref, cur, requested)
    assert [r["feature"] for r in found.collect()] == ["a"]
    assert drift.drift_summary(found, requested).first()["n_requested"] == 4


def test_gaps_are_dropped(spark):
    ref, cur = [1, None, 2, 3, None, 4], [2, 3, None]
    a = drift.detect_drift(frame(spark, a=ref), frame(spark, a=cur)).first()
    b = drift.detect_drift(frame(spark, a=[1, 2, 3, 4]), frame(spark, a=[2, 3])).first()
    assert a == b


def test_no_common_features(spark):
    assert drift.detect_drift(frame(spark, a=[1.0]), frame(spark, b=[1.0])).count() == 0
    empty = drift.drift_summary(drift.detect_drift(frame(spark, a=[1.0]), frame(spark, b=[1.0])), []).first()
    assert empty["drift_ratio"] == 0.0


@pytest.mark.parametrize("d, n, m", [(0.0, 100, 100), (0.05, 500, 400), (0.1, 1000, 800), (0.3, 50, 60), (1.0, 40, 40)])
def test_pvalue_is_the_kolmogorov_series(spark, d, n, m):
    lam = d * math.sqrt(n * m / (n + m))
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 101))
    expected = 1.0 if lam < 0.2 else min(1.0, max(0.0, series))
    df = spark.createDataFrame([(d, n, m)], "d double, n long, m long")
    assert df.select(drift.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).first()[0] == pytest.approx(expected, abs=1e-12)


def test_flags(spark):
    ref, cur = PAIRS["shifted"]
    row = drift.detect_drift(frame(spark, a=ref), frame(spark, a=cur)).first()
    assert row["ks_drift_detected"] and row["psi_drift_detected"] and row["drift_detected"]
    assert row["psi_band"] == "significant"
    ref, cur = PAIRS["identical"]
    row = drift.detect_drift(frame(spark, a=ref), frame(spark, a=cur)).first()
    assert not row["drift_detected"] and row["psi_band"] == "none" and row["ks_pvalue"] == 1.0


def test_summary_lists_drifted_features(spark):
    a, b = PAIRS["shifted"], PAIRS["same"]
    ref, cur = frame(spark, z=a[0][:900], y=b[0][:900]), frame(spark, z=a[1][:900], y=b[0][:900])
    row = drift.drift_summary(drift.detect_drift(ref, cur), ["z", "y"]).first()
    assert row["drifted_features"] == ["z"] and row["drift_ratio"] == 0.5


def gaps_of_all_orders(n, m):
    """The largest gap times n m of every order of two samples, by enumeration."""
    for first in itertools.combinations(range(n + m), n):
        i = j = top = 0
        for s in range(n + m):
            i, j = (i + 1, j) if s in first else (i, j + 1)
            top = max(top, abs(i * m - j * n))
        yield top


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (3, 3), (4, 7), (8, 8), (8, 6)])
def test_exact_pvalue_is_the_share_of_orders(n, m):
    gaps = list(gaps_of_all_orders(n, m))
    for reach in range(1, n * m + 1):
        want = sum(g >= reach for g in gaps) / len(gaps)
        assert drift.exact_ks_pvalue(reach / (n * m), n, m) == pytest.approx(want, abs=1e-12)


def test_exact_pvalue_of_larger_samples():
    assert drift.exact_ks_pvalue(0.6, 10, 10) == pytest.approx(0.05244755, abs=1e-8)
    assert drift.exact_ks_pvalue(0.29, 30, 70) == pytest.approx(0.0474, abs=5e-4)
    n = 4000
    lam = 0.03 * math.sqrt(n / 2)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert drift.exact_ks_pvalue(0.03, n, n) == pytest.approx(series, abs=2e-3)


def test_the_method_of_the_pvalue_decides_the_flag(spark):
    """30 against 70 values with a gap near 0.29: the exact value is the smaller one."""
    reference = spark.createDataFrame([(i, i / 30) for i in range(30)], "tx_id long, a double")
    current = [0.29 + (i + 0.5) / 70 * 0.71 for i in range(70)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(current)], "tx_id long, a double")
    d = drift.ks_statistic(reference, df, ["a"]).first()["ks_statistic"]
    exact, asymptotic = (drift.detect_drift(reference, df, ["a"], ks_alpha=a, p_method=p).first() for a, p in ((0.05, "exact"), (0.05, "asymptotic")))
    assert exact["ks_pvalue"] == pytest.approx(drift.exact_ks_pvalue(d, 30, 70), abs=1e-6)
    between = (exact["ks_pvalue"] + asymptotic["ks_pvalue"]) / 2
    flags = [drift.detect_drift(reference, df, ["a"], ks_alpha=between, p_method=p).first()["ks_drift_detected"] for p in ("exact", "asymptotic")]
    assert flags == [True, False]
    with pytest.raises(ValueError, match="p_method"):
        drift.detect_drift(reference, df, ["a"], p_method="auto")
