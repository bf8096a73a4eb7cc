"""Schemas of the tables, and the checks every source goes through."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

KEY = "tx_id"
LABEL = "Class"
COMPONENTS = [f"V{i}" for i in range(1, 29)]
# Order in which the scoring side expects the features.
FEATURES = ["Time", *COMPONENTS, "Amount"]
REQUIRED = ["Time", "Amount", "Class"]


class SchemaError(ValueError):
    """A table lacks columns or values that an operator cannot do without."""


def transaction_schema(with_key: bool = True) -> T.StructType:
    fields = [T.StructField(KEY, T.LongType(), False)] if with_key else []
    fields += [T.StructField(c, T.DoubleType()) for c in FEATURES]
    fields.append(T.StructField(LABEL, T.IntegerType()))
    return T.StructType(fields)


def record_schema() -> T.StructType:
    """One scoring record: key and features, no label."""
    return T.StructType(
        [T.StructField(KEY, T.LongType())] + [T.StructField(c, T.DoubleType()) for c in FEATURES]
    )


def registry_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("version", T.StringType(), False),
            T.StructField("registered_at", T.TimestampType(), False),
            T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
            T.StructField("params", T.MapType(T.StringType(), T.StringType())),
            T.StructField("model_path", T.StringType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField("notes", T.StringType()),
        ]
    )


def require_columns(df: DataFrame, names) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise SchemaError(f"Table is missing mandatory columns: {absent}")
    return df


def numeric_columns(df: DataFrame, exclude=(KEY,)) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN and NULL apart; every operator here treats only NULL as missing."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
