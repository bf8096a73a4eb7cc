import math
import os

import pytest
from pyspark.sql import functions as F

from wardenlake.operators.scoring import windowed_flags
from wardenlake.streaming import period_counts as p


def batch(spark, i, rows=20):
    """Every batch spreads over two days, so all are late for some period."""
    ids = spark.range(i * rows, (i + 1) * rows)
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.col("id") * 7919, F.lit(172_800)))
    return ids.select(ts.alias("ts"), (F.col("id") % 3 == 0).cast("int").alias("prediction"))


def tuples(df):
    return sorted(map(tuple, df.collect()))


def everything(spark, count):
    whole = batch(spark, 0)
    for i in range(1, count):
        whole = whole.union(batch(spark, i))
    return tuples(windowed_flags(whole))


def folders(path):
    return sorted(os.listdir(f"{path}/runs"))


def test_runs_stay_few(spark, tmp_path):
    counts, most = p.PeriodCounts(spark, str(tmp_path), fan_in=3), 0
    for i in range(28):
        assert counts.add(windowed_flags(batch(spark, i)), i)
        _, runs = counts.runs()
        assert [r.first for r in runs] == [0, *[r.last + 1 for r in runs[:-1]]] and runs[-1].last == i
        most = max(most, len(folders(tmp_path)))
    assert [(r.first, r.last, r.level) for r in runs] == [(0, 26, 3), (27, 27, 0)]
    assert most <= 2 * 2 * 4 + 4 and len(os.listdir(tmp_path / "_manifests")) <= 4  # two files and their checksums
    assert tuples(counts.read()) == everything(spark, 28)


def test_a_thousand_batches_leave_a_logarithm_of_runs():
    runs, most = [], 0
    for i in range(1000):
        runs.append(p.Run(i, i, 0, ""))
        while merged := p.to_merge(runs, 10):
            runs = [*runs[:-10], p.Run(merged[0].first, merged[-1].last, merged[0].level + 1, "")]
        most = max(most, len(runs))
    assert most <= 9 * math.ceil(math.log10(1000)) and [(r.first, r.last) for r in runs] == [(0, 999)]


def test_replays_add_nothing_also_after_a_merge(spark, tmp_path):
    counts = p.PeriodCounts(spark, str(tmp_path), fan_in=2)
    for i in (0, 1, 1, 2, 0, 2):
        counts.add(windowed_flags(batch(spark, i)), i)
    assert not counts.add(windowed_flags(batch(spark, 1)), 1)
    assert tuples(counts.read()) == everything(spark, 3)


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_crash_around_the_commit(spark, tmp_path, monkeypatch, step):
    """The batch comes again, as the stream replays it, and counts once."""
    counts, put = p.PeriodCounts(spark, str(tmp_path), fan_in=2), p.put_if_absent
    counts.add(windowed_flags(batch(spark, 0)), 0)

    def crash(*args):
        if step == "after":
            put(*args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(p, "put_if_absent", crash)
        with pytest.raises(RuntimeError):
            counts.add(windowed_flags(batch(spark, 1)), 1)
    seen = tuples(counts.read())
    assert seen == everything(spark, 1 if step == "before" else 2)
    assert counts.add(windowed_flags(batch(spark, 1)), 1) == (step == "before")
    for i in (2, 3, 4):
        counts.add(windowed_flags(batch(spark, i)), i)
    assert tuples(counts.read()) == everything(spark, 5)


def test_the_loser_of_a_race_adds_to_what_the_winner_left(spark, tmp_path, monkeypatch):
    counts, put, raced = p.PeriodCounts(spark, str(tmp_path), fan_in=2), p.put_if_absent, []

    def late(*args):
        if not raced:
            raced.append(True)
            p.PeriodCounts(spark, str(tmp_path), fan_in=2).add(windowed_flags(batch(spark, 0)), 0)
        return put(*args)

    monkeypatch.setattr(p, "put_if_absent", late)
    assert counts.add(windowed_flags(batch(spark, 1)), 1)
    assert tuples(counts.read()) == everything(spark, 2)


def test_a_reader_outlives_the_next_commit(spark, tmp_path):
    counts = p.PeriodCounts(spark, str(tmp_path), fan_in=2)
    for i in (0, 1, 2):
        counts.add(windowed_flags(batch(spark, i)), i)
    reader = counts.read()
    counts.add(windowed_flags(batch(spark, 3)), 3)
    assert tuples(reader) == everything(spark, 3)
    assert tuples(counts.read()) == everything(spark, 4)


def test_nothing_yet(spark, tmp_path):
    counts = p.PeriodCounts(spark, str(tmp_path))
    assert counts.runs() == (0, []) and counts.read().count() == 0
    counts.add(windowed_flags(batch(spark, 0).where("prediction > 1")), 0)
    assert counts.read().count() == 0 and not counts.add(windowed_flags(batch(spark, 0)), 0)
