"""Whole-table copies, exact duplicates removal and data-quality counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def copy_dimension(df: DataFrame) -> DataFrame:
    """Every row and column, unchanged."""
    return df.select("*")


def empty_like(df: DataFrame) -> DataFrame:
    """No rows, same schema: what a truncated table holds."""
    return df.limit(0)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without exact copies. Copies collapse before the shuffle."""
    return df.distinct()


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_rows) for each column, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def duplicate_key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys occur more than once, and how many rows are surplus."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return per_key.agg(
        F.count("*").alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def require_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Return ``df``, or raise when a key occurs twice."""
    repeated = duplicate_key_counts(df, keys).first()["duplicate_keys"]
    if repeated:
        raise ValueError(f"{name}: {repeated} values of {', '.join(keys)} are not unique")
    return df
