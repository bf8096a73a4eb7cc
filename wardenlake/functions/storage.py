"""Tables that cut a lineage: written once to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="wardenlake-")


def new_folder(spark: SparkSession) -> str:
    """A folder of its own below one that is named after the application."""
    return f"{shared_folder(spark)}/wardenlake/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` once and read it back.

    Later steps start from files, so they neither recompute `df` nor depend on the executors
    that made it, and the optimizer knows its size when it picks a join strategy.
    """
    path = new_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """As `materialize`, but every row stays in its partition and in its place there, which a table of files doesn't promise.

    A learner sends its rows' whole lineage with each of its many tasks; here that is the checkpoint alone.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(new_folder(df.sparkSession))
    return df.checkpoint()


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few files a task per core. Larger tables keep their splits: no shuffle.

    Meant for plans of scans and projections, whose partitions are known without running them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
