from datetime import datetime
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from wardenlake.schema import SchemaError, registry_schema, transaction_schema
from wardenlake.sources import reports, transactions
from wardenlake.sources.commit_log import CommittedTable
from wardenlake.sources.registry import ModelRegistry, best_version, list_versions


def write_csv(path, text):
    path.write_text(text)
    return str(path)


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "many").mkdir()
    write_csv(tmp_path / "many" / "a.csv", "Time,Amount,Class\n1,2,0\n")
    write_csv(tmp_path / "many" / "b.csv", "Amount,Time,Class\n200,2,0\n")
    with pytest.raises(Exception, match="header|Header"):
        transactions.load_transactions(spark, str(tmp_path / "many")).collect()


def test_csv_columns_in_any_order(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", "Class,Amount,V1,Time\n1,2.5,0.1,10\n0,3,,20\n")
    df = transactions.load_transactions(spark, path)
    assert dict(df.dtypes) == {"Class": "int", "Amount": "double", "V1": "double", "Time": "double"}
    assert [tuple(r) for r in df.orderBy("Time").collect()] == [(1, 2.5, 0.1, 10.0), (0, 3.0, None, 20.0)]


def test_shape_and_positives(spark, tmp_path):
    df = spark.range(200).select(
        *[F.lit(1.0).alias(f.name) for f in transaction_schema(False).fields[:-1]], (F.col("id") < 20).cast("int").alias("Class")
    )
    df.write.option("header", True).csv(str(tmp_path / "t"))
    got = transactions.load_transactions(spark, str(tmp_path / "t"))
    assert (got.count(), len(got.columns), got.agg(F.sum("Class")).first()[0]) == (200, 31, 20)


def test_missing_columns_are_named(spark, tmp_path):
    path = write_csv(tmp_path / "b.csv", "V1,Class\n1,0\n2,1\n")
    with pytest.raises(SchemaError, match="missing.*Time.*Amount"):
        transactions.load_transactions(spark, path)


def test_malformed_values_end_the_job(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", "Time,Amount,Class\n1,oops,0\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|CANNOT_PARSE"):
        transactions.load_transactions(spark, path).collect()


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        transactions.load_transactions(spark, str(tmp_path / "none.csv"))


def test_upload_needs_no_label(spark, tmp_path):
    path = write_csv(tmp_path / "d.csv", "V1,Amount\n1,2\n")
    assert transactions.load_records(spark, path).columns == ["V1", "Amount"]


def test_landing_gives_keys(spark, tmp_path):
    df = spark.range(50).select(F.col("id").cast("double").alias("Time"))
    got = transactions.land_transactions(df, str(tmp_path / "l"))
    assert got.select("tx_id").distinct().count() == 50


def test_partitions(spark, tmp_path):
    df = spark.range(10).select("id", F.when(F.col("id") < 3, "test").otherwise("train").alias("split"))
    transactions.write_partitions(df, str(tmp_path / "p"))
    test = transactions.read_partition(spark, str(tmp_path / "p"), "test")
    assert test.count() == 3 and test.columns == ["id"]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([(0.5, 3)], "f1 double, tp long")
    reports.save_metrics_report(rows, "Random Forest Champion", str(tmp_path / "m"))
    reports.save_cost_report(rows, "LR", str(tmp_path / "c"))
    reports.save_drift_report(rows, str(tmp_path / "d"), current_period="June")
    assert spark.read.json(str(tmp_path / "m")).first()["report"] == "random_forest_champion"
    assert spark.read.json(str(tmp_path / "c")).first()["report"] == "lr"
    drift = spark.read.json(str(tmp_path / "d")).first()
    assert (drift["reference_period"], drift["current_period"]) == ("training data", "June")


def test_registry(spark, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "r"))
    assert reg.list_versions().count() == 0 and reg.best_version().count() == 0
    day = lambda d: datetime(2024, 1, d)
    assert reg.register("a", {"f1": 0.5, "auc": 0.9}, {"depth": 3}, "models/a", ["x"], registered_at=day(1))
    assert reg.register("b", {"f1": 0.7}, registered_at=day(2))
    assert not reg.register("a", {"f1": 0.99}, registered_at=day(3))
    assert [r["version"] for r in reg.list_versions().collect()] == ["b", "a"]
    assert reg.get("a").first()["metrics"] == {"f1": 0.5, "auc": 0.9}
    assert reg.get("a").first()["params"] == {"depth": "3"}
    assert reg.best_version().first()["version"] == "b"
    assert reg.best_version(higher_is_better=False).first()["version"] == "a"
    assert reg.best_version("nothing").count() == 0
    assert reg.register("a", {"f1": 0.9}, overwrite=True, registered_at=day(4))
    assert reg.best_version().first()["version"] == "a"
    got = {r["metric"]: (r["b"], r["a"]) for r in reg.compare(["b", "a", "none"]).collect()}
    assert got == {"f1": (0.7, 0.9)}
    assert reg.delete("a") and not reg.delete("a")
    assert [r["version"] for r in reg.list_versions().collect()] == ["b"]
    assert reg.model_info("models/a").first()["status"] == "not_found"
    assert reg.delete("b") and reg.list_versions().count() == 0


def test_first_registered_wins_a_tie(spark):
    rows = [("late", datetime(2024, 2, 1), {"f1": 0.5}), ("early", datetime(2024, 1, 1), {"f1": 0.5})]
    df = spark.createDataFrame(rows, "version string, registered_at timestamp, metrics map<string,double>")
    assert best_version(df).first()["version"] == "early"
    assert list_versions(df).first()["version"] == "late"


def at_once(count, job):
    with ThreadPool(count) as pool:
        return pool.map(job, range(count))


def test_one_of_many_writers_registers_a_name(spark, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "r"))
    done = at_once(8, lambda i: reg.register("v1", {"f1": i / 10}))
    assert sorted(done) == [False] * 7 + [True]
    assert reg.get("v1").first()["metrics"] == {"f1": done.index(True) / 10}


def test_no_registration_is_lost(spark, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "r"))
    assert all(at_once(8, lambda i: reg.register(f"v{i}", {"f1": i / 10})))
    assert {r["version"] for r in reg.list_versions().collect()} == {f"v{i}" for i in range(8)}
    assert all(at_once(6, lambda i: reg.add_metrics("v0", {f"m{i}": i})))
    assert reg.get("v0").first()["metrics"] == {"f1": 0.0, **{f"m{i}": float(i) for i in range(6)}}
    assert sorted(at_once(4, lambda i: reg.delete("v7"))) == [False, False, False, True]
    assert [n for n, _ in reg.table.commits()] == list(range(1, 16))


def test_many_entries_in_one_commit(spark, tmp_path):
    reg = ModelRegistry(spark, str(tmp_path / "r"))
    rows = [(f"v{i}", datetime(2024, 1, 1 + i), {"f1": i / 10}, {}, "p", [], "") for i in range(5)]
    df = spark.createDataFrame([*rows, ("v0", datetime(2024, 2, 1), {"f1": 0.95}, {}, "p", [], "")], registry_schema())
    assert reg.register("v3", {"f1": 0.5}) and reg.register_all(df) and not reg.register_all(df)
    assert reg.table.latest() == 2 and reg.entries().count() == 5
    assert reg.get("v3").first()["metrics"] == {"f1": 0.5} and reg.get("v0").first()["metrics"] == {"f1": 0.95}
    assert reg.register_all(df.where("version = 'v3'"), overwrite=True) and reg.get("v3").first()["metrics"] == {"f1": 0.3}


def test_reports_of_many_writers(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = spark.range(100).select(F.rand(1).alias("f1")).repartition(3)
    at_once(6, lambda i: reports.save_metrics_report(rows, f"Model {i}", path))
    got = reports.read_reports(spark, path).groupBy("report").count().collect()
    assert {r["report"]: r["count"] for r in got} == {f"model_{i}": 100 for i in range(6)}


def test_unfinished_batches_are_not_read(spark, tmp_path):
    table = CommittedTable(spark, str(tmp_path / "t"))
    assert table.append(spark.range(3)) == 1
    table._write(spark.range(50))  # a writer that ended before its commit
    assert table.read().count() == 3 and table.read(0).count() == 0
    assert table.update(lambda so_far: None) is None and table.latest() == 1
    assert not table._put(1, "b-late") and [p.name for p in (tmp_path / "t" / "_commits").iterdir()] == [f"{1:020d}.json"]
