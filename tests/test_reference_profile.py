import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_drift import PAIRS, frame, ks_of
from wardenlake.operators import drift, reference_profile as p


def tuples(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("name", PAIRS)
def test_same_statistic_as_from_the_reference(spark, tmp_path, name):
    ref, cur = (frame(spark, a=x) for x in PAIRS[name])
    profile = p.write_profile(ref, str(tmp_path / "p"))
    assert tuples(p.ks_against_profile(profile, cur)) == tuples(drift.ks_statistic(ref, cur))
    assert p.ks_against_profile(profile, cur).first()["ks_statistic"] == pytest.approx(ks_of(*PAIRS[name]), abs=1e-12)


def test_many_narrow_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(drift, "OPEN_ROWS", 5)
    monkeypatch.setattr(drift, "LOCAL_BUCKETS", 0)
    monkeypatch.setattr(drift, "BROADCAST_BUCKETS", 0)
    ref, cur = (frame(spark, a=x) for x in PAIRS["one log bucket"])
    profile = p.write_profile(ref, str(tmp_path / "p"))
    assert p.ks_against_profile(profile, cur).first()["ks_statistic"] == pytest.approx(ks_of(*PAIRS["one log bucket"]), abs=1e-12)


def test_findings_equal_those_from_the_reference(spark, tmp_path):
    rng = np.random.default_rng(2)
    gaps = [None if i % 7 == 0 else v for i, v in enumerate(rng.normal(size=400))]
    ref = frame(spark, a=rng.normal(size=400), b=gaps, w=rng.exponential(size=400) * -1e6).withColumnRenamed("w", "Big one/é")
    cur = frame(spark, a=rng.normal(0.4, 1, 300), b=[float("nan"), *rng.normal(size=299)], other=np.ones(300))
    profile = p.write_profile(ref, str(tmp_path / "p"))
    again = p.open_profile(spark, str(tmp_path / "p"))
    assert again == profile and again.features() == ["a", "b", "Big one/é"]
    assert tuples(p.detect_drift_from_profile(again, cur)) == tuples(drift.detect_drift(ref, cur))
    exact = {"p_method": "exact", "features": ["a", "nothing"]}
    assert tuples(p.detect_drift_from_profile(again, cur, **exact)) == tuples(drift.detect_drift(ref, cur, **exact))
    known = {(r["feature"], r["value"], r["n"]) for r in profile.values().where("feature = 'Big one/é'").collect()}
    assert len(known) == 400 and all(v <= 0 for _, v, _ in known)


def test_only_undecided_octaves_are_read(spark, tmp_path):
    rng = np.random.default_rng(4)
    ref = frame(spark, a=rng.lognormal(0, 3, 4000), b=rng.normal(size=4000))
    cur = frame(spark, a=rng.lognormal(0.8, 3, 4000), b=rng.normal(0.3, 1, 4000))
    profile = p.write_profile(ref, str(tmp_path / "p"))
    asked = []

    class Watched(p.ReferenceProfile):
        def values(self, wanted=None):
            asked.append(super().values(wanted))
            return asked[-1]

    p.ks_against_profile(Watched(spark, profile.path), cur).collect()
    assert len(asked) == 1
    plan = asked[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "octave" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    read, whole = asked[0].agg(F.sum("n")).first()[0], profile.values().agg(F.sum("n")).first()[0]
    assert whole == 8000 and read < whole / 2


def test_edge_tables(spark, tmp_path):
    none = frame(spark, a=[None, None, float("nan")])
    profile = p.write_profile(none, str(tmp_path / "none"))
    some = frame(spark, a=[1.0, 2.0])
    assert p.detect_drift_from_profile(profile, some).count() == drift.detect_drift(none, some).count() == 0
    profile = p.write_profile(some, str(tmp_path / "some"))
    assert p.detect_drift_from_profile(profile, none).count() == 0
    assert p.detect_drift_from_profile(profile, frame(spark, z=[1.0])).count() == 0
    with pytest.raises(FileExistsError):
        p.write_profile(some, str(tmp_path / "some"))
    with pytest.raises(ValueError, match="numeric"):
        p.write_profile(spark.createDataFrame([("x",)], "t string"), str(tmp_path / "text"))
    assert p.open_profile(spark, str(tmp_path / "absent")) is None


def test_a_broken_attempt_is_no_profile_and_is_replaced(spark, tmp_path, monkeypatch):
    path, some = str(tmp_path / "p"), frame(spark, a=[1.0, 2.0, 2.0])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(p, "fit_psi", fail)
        with pytest.raises(RuntimeError):
            p.write_profile(some, path)
    assert p.open_profile(spark, path) is None
    assert tuples(p.write_profile(some, path).values()) == [("a", 1.0, 1), ("a", 2.0, 2)]
