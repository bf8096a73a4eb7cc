"""Imputation, capping and scaling as fit-then-project: statistics are literals in one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from wardenlake.functions.order_stats import exact_quantiles
from wardenlake.schema import KEY, LABEL, numeric_columns


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without values has none."""
    return {c: v[0] for (_, c), v in exact_quantiles(df, columns, [0.5]).items()}


def impute_median(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill the gaps of numeric columns with the column's median. Columns without gaps cost nothing."""
    columns = list(columns or numeric_columns(df, exclude=(KEY, LABEL)))
    if not columns:
        return df
    missing = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gappy = [c for c in columns if missing[c]]
    return fill(df, medians(df, gappy)) if gappy else df


def fill(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()}) if values else df


def upper_caps(df: DataFrame, columns: Sequence[str] = ("Amount",), quantile: float = 0.999) -> dict[str, float]:
    present = [c for c in columns if c in df.columns]
    return {c: v[0] for (_, c), v in exact_quantiles(df, present, [quantile]).items()} if present else {}


def cap(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """Replace values strictly above the cap; missing values stay missing."""
    return df.withColumns({c: F.when(F.col(c) > v, F.lit(v)).otherwise(F.col(c)) for c, v in caps.items()}) if caps else df


def winsorize(df: DataFrame, columns: Sequence[str] = ("Amount",), quantile: float = 0.999) -> DataFrame:
    """Cap the upper tail at an exact quantile. Columns the table lacks are passed over."""
    return cap(df, upper_caps(df, columns, quantile))


def outlier_counts(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """One row: how many values of each column exceed its cap."""
    return df.agg(*[F.count_if(F.col(c) > v).alias(c) for c, v in caps.items()])


def scale_moments(df: DataFrame, columns: Sequence[str] = ("Time", "Amount")) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column; a constant column is divided by 1."""
    got = df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_sd") for c in columns]
    ).first()
    return {c: (got[f"{c}_mean"] or 0.0, got[f"{c}_sd"] or 1.0) for c in columns}


def scaled(column: str, mean: float, deviation: float):
    return (F.col(column) - F.lit(mean)) / F.lit(deviation)


def standard_scale(df: DataFrame, columns: Sequence[str] = ("Time", "Amount")) -> DataFrame:
    moments = scale_moments(df, columns)
    return df.withColumns({c: scaled(c, *moments[c]) for c in columns})
