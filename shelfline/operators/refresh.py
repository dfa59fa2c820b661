"""High-water marks and delete-last-key-then-append refresh.

A refresh re-reads the last loaded key, because it may have been loaded while
still incomplete, and everything after it. Rows older than the mark are not
read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def high_water(df: DataFrame, key: str) -> DataFrame:
    """One row holding the greatest key, null when there is none."""
    return df.agg(F.max(key).alias("high_water"))


def mark_of(df: DataFrame, key: str) -> Column:
    """The greatest key as a scalar subquery, 0 when there is none.

    The default sits inside the subquery so that a comparison with a column is
    a plain ``column >= value`` by run time, which the Parquet scan can use to
    skip row groups.
    """
    return df.agg(F.coalesce(F.max(key), F.lit(0))).scalar()


def read_mark(df: DataFrame, key: str) -> int:
    """The same mark read now, for callers that want a literal in the plan."""
    return df.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]


def as_mark(mark: Column | int) -> Column:
    return F.lit(mark) if isinstance(mark, int) else mark


def rows_from(df: DataFrame, key: str, mark: Column | int) -> DataFrame:
    """Rows at or after the mark; a null key is never loaded."""
    return df.filter(F.col(key) >= as_mark(mark))


def rows_kept(target: DataFrame, key: str, mark: Column | int) -> DataFrame:
    """The target without its rows at the mark. Null keys stay."""
    return target.filter(~F.col(key).eqNullSafe(as_mark(mark)))


def incremental_refresh(
    target: DataFrame, fresh: DataFrame, key: str, mark: Column | int | None = None
) -> DataFrame:
    """Whole new state of ``target``: last key dropped, ``fresh`` rows from it on appended."""
    if mark is None:
        mark = mark_of(target, key)
    kept = rows_kept(target, key, mark)
    return kept.unionByName(rows_from(fresh, key, mark).select(target.columns))
