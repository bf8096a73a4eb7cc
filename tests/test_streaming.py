import pytest
from pyspark.sql import functions as F

from wardenlake.models import training
from wardenlake.operators.drift import detect_drift
from wardenlake.operators.scoring import score_batch, windowed_flags
from wardenlake.plans.catalog import QUERIES
from wardenlake.streaming import scoring as streams

NAMES = ["Time", "V1", "V2", "V3", "V4", "V5", "V6", "Amount"]


@pytest.fixture
def landed(signal, tmp_path):
    """The table in four files, read as a stream of one file per batch."""
    signal.drop("Class").repartition(4).write.parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def finish(query):
    query.awaitTermination(300)
    assert query.exception() is None


def stream(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch(spark, signal, landed, tmp_path):
    model = training.train_baseline(signal)
    out = str(tmp_path / "out")
    finish(streams.score_stream(model, stream(spark, landed), out, str(tmp_path / "cp"), NAMES))
    batch = score_batch(model, signal, NAMES)
    got = spark.read.parquet(out)
    assert got.count() == signal.count()
    assert got.exceptAll(batch).count() == 0
    # a second run finds nothing new
    finish(streams.score_stream(model, stream(spark, landed), out, str(tmp_path / "cp"), NAMES))
    assert spark.read.parquet(out).count() == signal.count()


def test_all_periods_equal_batch(spark, tmp_path):
    """Also open ones, and rows that come long after their period."""
    rows = spark.range(1000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"), (F.col("id") % 10 == 0).cast("int").alias("prediction")
    )
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows.repartition(5).write.parquet(path)
    for run in ("a", "b"):  # the second replays every batch
        finish(streams.flag_rate_stream(stream(spark, path), out, str(tmp_path / run)))
        found = streams.read_flag_rates(spark, out)
        assert found.count() == 17
        assert found.exceptAll(windowed_flags(rows)).count() == 0


def test_streams_of_a_directory_table(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("streamed_scores", "streamed_flags"):
        one, other = (sorted(map(tuple, QUERIES[name](spark, d).collect())) for d in ("/root/testdata/sf0.001", str(tmp_path)))
        assert one == other and len(one) > 0


def test_drift_per_batch(spark, signal, landed, tmp_path):
    out = str(tmp_path / "out")
    reference = signal.where("tx_id < 2500")
    finish(streams.drift_stream(reference, stream(spark, landed), out, str(tmp_path / "cp"), ["Amount", "V1"]))
    got = streams.read_drift(spark, out)
    assert got.count() == 8 and got.select("batch_id").distinct().count() == 4


def test_replayed_batch_overwrites_itself(spark, signal, landed, tmp_path):
    out, reference = str(tmp_path / "out"), signal.where("tx_id < 500")
    for run in ("a", "b"):  # a lost checkpoint replays all batches
        finish(streams.drift_stream(reference, stream(spark, landed), out, str(tmp_path / run), ["Amount"]))
    assert streams.read_drift(spark, out).count() == 4
    whole = detect_drift(reference, signal, ["Amount"]).first()
    assert whole["feature"] == "Amount"
