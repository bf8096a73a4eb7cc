"""Loading CSV files with bad lines: one pass parts them into accepted rows and rejects that say why.

What FAILFAST would end the job for is what gets rejected: a cell that isn't a number, too few or too many fields.
Both parts land in one table with a directory each, so accepted rows and rejects add up to the lines that were read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardenlake.schema import REQUIRED, nan_to_null
from wardenlake.sources.transactions import csv_columns

LINE = "_corrupt_record"
PART = "part"
ACCEPTED, REJECTED = "accepted", "rejected"
FIELDS = "wrong number of fields"


class TooManyRejects(ValueError):
    """More bad lines than the caller allows. Both parts are on disk all the same."""


def _with_reasons(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds `reason`, NULL for an accepted row. Cells are parsed again for rejects alone."""
    text = ", ".join(f"`{f.name}` string" for f in schema)
    cells = rows.withColumn("__cells", F.when(F.col(LINE).isNotNull(), F.from_csv(F.col(LINE), text)))

    def unparsed(field: T.StructField):
        cell = F.col("__cells")[field.name]
        return F.when(cell.isNotNull() & cell.try_cast(field.dataType).isNull(), F.lit(field.name))

    named = F.array_compact(F.array(*[unparsed(f) for f in schema]))
    why = F.when(F.size(named) > 0, F.concat(F.lit("not a number: "), F.array_join(named, ", "))).otherwise(F.lit(FIELDS))
    return cells.withColumn("reason", F.when(F.col(LINE).isNotNull(), why)).drop("__cells")


def load_with_quarantine(
    spark: SparkSession, path: str, out: str, required=REQUIRED, most_rejects: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejects) of a CSV path, landed below `out`.

    Accepted rows are those `load_transactions` gives. Rejects are (file, line, reason). Blank lines count as no line. A
    header that lacks required columns, or differs between files, still ends the job: no row of such a file can be trusted.
    With `most_rejects`, more bad lines than that raise `TooManyRejects` after both parts are written.
    """
    schema = csv_columns(spark, path, required)
    lines = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(LINE, T.StringType())]))
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    parts = _with_reasons(nan_to_null(lines), schema).withColumn(
        PART, F.when(F.col(LINE).isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED))
    )
    parts.withColumn("file", F.when(F.col(LINE).isNotNull(), F.col("file"))).write.mode("overwrite").partitionBy(PART).parquet(out)
    landed = spark.read.schema(parts.schema).parquet(out)
    accepted = landed.where(F.col(PART) == ACCEPTED).select(*schema.names)
    rejects = landed.where(F.col(PART) == REJECTED).select("file", F.col(LINE).alias("line"), "reason")
    if most_rejects is not None:
        found = rejects.count()
        if found > most_rejects:
            raise TooManyRejects(f"{found} lines of {path} can't be read, {most_rejects} are allowed; see {out}/{PART}={REJECTED}")
    return accepted, rejects
