import pytest

from wardenlake.schema import SchemaError
from wardenlake.sources.quarantine import FIELDS, TooManyRejects, load_with_quarantine
from wardenlake.sources.transactions import load_transactions

GOOD = ["1,0.5,10,0", "2,1.5,,1", "3,NaN,1e3,0"]
BAD = {
    "4,x,10,0": "not a number: Time",
    "5,1.0,ten,no": "not a number: Amount, Class",
    "6,1.0,2.0,1.5": "not a number: Class",
    "7,1.0": FIELDS,
    "8,1.0,2.0,0,9,9": FIELDS,
    "x,1,2,0": "not a number: tx_id",
}


def write(folder, lines, header="tx_id,Time,Amount,Class", name="a.csv"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def test_parts_add_up_to_the_lines(spark, tmp_path):
    path = write(tmp_path / "in", [GOOD[0], *BAD, "", GOOD[1]])
    write(tmp_path / "in", [GOOD[2]], name="b.csv")
    accepted, rejects = load_with_quarantine(spark, path, str(tmp_path / "out"))
    assert sorted(map(tuple, accepted.collect())) == [(1, 0.5, 10.0, 0), (2, 1.5, None, 1), (3, None, 1000.0, 0)]
    assert {r["line"]: r["reason"] for r in rejects.collect()} == BAD
    assert all(r["file"].endswith("/a.csv") for r in rejects.collect())
    assert accepted.count() + rejects.count() == len(GOOD) + len(BAD)


def test_accepted_rows_are_those_of_the_strict_load(spark, tmp_path):
    path = write(tmp_path / "in", GOOD)
    accepted, rejects = load_with_quarantine(spark, path, str(tmp_path / "out"))
    strict = load_transactions(spark, path)
    assert accepted.schema == strict.schema and sorted(map(tuple, accepted.collect())) == sorted(map(tuple, strict.collect()))
    assert rejects.count() == 0
    for line in BAD:  # each alone ends the strict load
        with pytest.raises(Exception):
            load_transactions(spark, write(tmp_path / "bad", [line])).collect()


def test_the_limit_is_counted_after_both_parts_are_written(spark, tmp_path):
    path, out = write(tmp_path / "in", [*GOOD, *BAD]), str(tmp_path / "out")
    load_with_quarantine(spark, path, out, most_rejects=len(BAD))
    with pytest.raises(TooManyRejects, match="6 lines"):
        load_with_quarantine(spark, path, out, most_rejects=5)
    assert spark.read.parquet(out).count() == len(GOOD) + len(BAD)


def test_only_bad_lines_no_lines_and_a_wrong_header(spark, tmp_path):
    accepted, rejects = load_with_quarantine(spark, write(tmp_path / "bad", BAD), str(tmp_path / "out1"))
    assert (accepted.count(), rejects.count()) == (0, len(BAD))
    accepted, rejects = load_with_quarantine(spark, write(tmp_path / "none", []), str(tmp_path / "out2"))
    assert (accepted.count(), rejects.count()) == (0, 0)
    with pytest.raises(SchemaError):
        load_with_quarantine(spark, write(tmp_path / "short", GOOD, "tx_id,Time,Amount,Kind"), str(tmp_path / "out3"))
