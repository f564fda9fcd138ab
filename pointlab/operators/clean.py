"""Missing values, invalid rows, repeated points and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlab.functions import is_missing
from pointlab.operators.features import table_statistics
from pointlab.schema import ARTIFACT_CODES, FEATURE_COLUMNS


def impute_features(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Zero in place of NULL and NaN, in the feature columns only."""
    return df.fillna(0, subset=list(columns))


def row_is_valid(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> Column:
    """True where every given column has a value."""
    types = {field.name: field.dataType for field in df.schema}
    valid = F.lit(True)
    for name in columns:
        valid = valid & ~is_missing(name, types[name])
    return valid


def drop_invalid(df: DataFrame, columns: Sequence[str] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """Rows whose feature columns all have a value."""
    return df.dropna(subset=list(columns))


def missing_report(df: DataFrame, columns: Sequence[str], split_column: str = "split") -> DataFrame:
    """Rows, and missing values per split and column, in one pass over the table."""
    types = {field.name: field.dataType for field in df.schema}
    wide = df.groupBy(split_column).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(is_missing(name, types[name])).alias(name) for name in columns],
    )
    return wide.unpivot([split_column, "n_rows"], list(columns), "column_name", "n_missing")


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct value of all columns, or of the given ones.

    Copies collapse before the shuffle, so a heavily repeated point is sent once per task.
    """
    return df.dropDuplicates(list(columns)) if columns else df.distinct()


def drop_artifacts(df: DataFrame, codes: Sequence[int] = tuple(ARTIFACT_CODES)) -> DataFrame:
    """Drop points whose raw class code marks an artifact; points without a code stay.

    Meant for raw codes, before remapping: the condition then reaches the Parquet scan.
    """
    code = F.col("Classification")
    return df.where(code.isNull() | ~code.isin(*codes))


def drop_outliers(df: DataFrame, k: float = 3.0, value: str = "z") -> DataFrame:
    """Rows whose ``value`` lies within ``k`` standard deviations of the mean of their split.

    Rows without a value are left to the missing-value operators.
    """
    column = F.col(value)
    stats = table_statistics(
        df,
        "split" in df.columns,
        mean=F.avg(column),
        sd=F.stddev_samp(column),
    )
    near = F.abs(column - stats["mean"]) <= F.lit(float(k)) * stats["sd"]
    return df.where(F.coalesce(near, F.lit(True)))
