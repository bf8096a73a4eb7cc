import os
import sys

import pytest
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def signal(spark):
    """5,000 transactions, 2 % positives, whose features tell the classes apart."""
    from wardenlake.functions.hashing import hash_key, unit_interval

    def normal(name):
        key = hash_key("tx_id", name)
        u, v = unit_interval(key), unit_interval(key, 9)
        return F.sqrt(-2.0 * F.log(1.0 - u)) * F.cos(2.0 * F.pi() * v)

    positive = F.col("tx_id") % 50 == 0
    df = spark.range(5000).withColumnRenamed("id", "tx_id").select(
        "tx_id",
        (unit_interval(hash_key("tx_id", "t")) * 172800.0).alias("Time"),
        *[
            F.when(positive, F.lit(-1.5) + 2.0 * normal(f"v{i}")).otherwise(normal(f"v{i}")).alias(f"V{i}")
            for i in range(1, 7)
        ],
        (-F.log(1.0 - unit_interval(hash_key("tx_id", "a"))) * F.when(positive, 150.0).otherwise(50.0)).alias("Amount"),
        positive.cast("int").alias("Class"),
    )
    return df.cache()


def scored(spark, labels, scores):
    return spark.createDataFrame(
        [(i, int(y), float(s), int(s > 0.5)) for i, (y, s) in enumerate(zip(labels, scores))],
        "tx_id long, Class int, score double, prediction int",
    )
