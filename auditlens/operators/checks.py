"""Data checks. Each returns the rows that break the rule; no row means the check passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations of the columns that occur more than once."""
    return df.groupBy(*columns).count().filter("count > 1").select(*columns)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often. NULL is no value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())
