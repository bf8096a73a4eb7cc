"""Reading transaction tables and landing them as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardenlake.schema import KEY, LABEL, REQUIRED, nan_to_null, require_columns


def csv_columns(spark: SparkSession, path: str, required=REQUIRED) -> T.StructType:
    """The declared types of the columns that the header line names."""
    header = require_columns(spark.read.option("header", True).csv(path), required).columns
    integral = {KEY: T.LongType(), LABEL: T.IntegerType()}
    return T.StructType([T.StructField(c, integral.get(c, T.DoubleType())) for c in header])


def load_transactions(spark: SparkSession, path: str, fmt: str = "csv", required=REQUIRED) -> DataFrame:
    """Scan a transaction table; every column is DOUBLE but the key and the label.

    CSV columns may come in any order, the same in all files of a path: a file with another header ends the job. Only the
    header line is read ahead: types are declared, and a value that does not parse ends the job instead of turning into NULL. NaN becomes NULL;
    a landed table went through that once and needs no second pass (`spark.read`).
    """
    if fmt == "csv":
        schema = csv_columns(spark, path, required)
        table = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    else:
        table = require_columns(spark.read.format(fmt).load(path), required)
    return nan_to_null(table)


def load_records(spark: SparkSession, path: str) -> DataFrame:
    """Scan an uploaded CSV of records to score: any subset of the features, no label needed."""
    return load_transactions(spark, path, required=())


def with_key(df: DataFrame, key: str = KEY) -> DataFrame:
    """Give every row a unique BIGINT. Land the table afterwards, so that the keys stay."""
    return df if key in df.columns else df.select(F.monotonically_increasing_id().alias(key), "*")


def land_transactions(df: DataFrame, path: str) -> DataFrame:
    with_key(df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partitions(split: DataFrame, path: str) -> None:
    """Persist the train and test rows, one directory each, for scans that need only one."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def read_partition(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")
