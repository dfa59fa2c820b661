"""Type-2 history: merge current source rows into a table of versions.

Two sets of rules are offered.

``null_safe`` compares every column with null-safe equality, looks at open
versions only, closes an open version when the source still has its key but no
longer has that row, and leaves closed versions alone.

``reference`` keeps the looser rules of the SQL this library replaces: equality
is strict on most columns (a null never matches), a null counts as 0 in the
``zero_default`` columns, closed versions take part in both steps, and the
closing date is written again whenever a version still differs.

Neither removes or closes versions whose key has left the source.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mode = Literal["null_safe", "reference"]


def as_of_column(as_of: Column | str | None) -> Column:
    """Run date as a timestamp without zone; today when none is given."""
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, str):
        as_of = F.lit(as_of)
    return as_of.cast("date").cast("timestamp_ntz")


def scd2_merge(
    snapshot: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    as_of: Column | str | None = None,
    mode: Mode = "null_safe",
    zero_default: Sequence[str] = (),
) -> DataFrame:
    """Whole new state of ``snapshot`` after merging ``source``.

    ``columns`` are the compared source columns, the key among them.
    ``snapshot`` also has ``start_date`` and ``end_date``; null means open.
    """
    stamp = as_of_column(as_of)
    source = source.select(*columns)
    snapshot = snapshot.select(*columns, "start_date", "end_date")
    if mode == "null_safe":
        return _merge_null_safe(snapshot, source, key, columns, stamp)
    if mode == "reference":
        return _merge_reference(snapshot, source, key, columns, stamp, zero_default)
    raise ValueError(f"unknown mode {mode!r}")


def _opened(rows: DataFrame, columns: Sequence[str], stamp: Column) -> DataFrame:
    return rows.select(
        *columns, stamp.alias("start_date"), F.lit(None).cast("timestamp_ntz").alias("end_date")
    )


def _merge_null_safe(
    snapshot: DataFrame, source: DataFrame, key: str, columns: Sequence[str], stamp: Column
) -> DataFrame:
    # A struct never is null and equals another field by field, nulls included, so
    # one plain equality compares whole rows and one shuffle serves both the
    # removal of copies and the join.
    packed = F.struct(*columns).alias("row")
    closed = snapshot.filter("end_date is not null")
    current = snapshot.filter("end_date is null").select(packed, "start_date")
    incoming = source.select(packed)

    # Both lookups are distinct: every open version keeps exactly one row, and a
    # heavily repeated source row shrinks before it is shuffled.
    same = incoming.distinct().withColumn("is_same", F.lit(True))
    seen = source.select(F.struct(key).alias("seen_key")).distinct()
    seen = seen.withColumn("is_seen", F.lit(True))
    version_key = F.struct(F.col(f"row.{key}").alias(key))
    checked = current.join(same, "row", "left").join(
        seen, version_key == F.col("seen_key"), "left"
    )
    outdated = F.col("is_seen").isNotNull() & F.col("is_same").isNull()
    kept = checked.select("row.*", "start_date", F.when(outdated, stamp).alias("end_date"))

    added = incoming.join(current.select("row").distinct(), "row", "left_anti").select("row.*")
    return closed.unionByName(kept).unionByName(_opened(added, columns, stamp))


def _merge_reference(
    snapshot: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    stamp: Column,
    zero_default: Sequence[str],
) -> DataFrame:
    def compared(name: str, prefix: str = "") -> Column:
        value = F.col(prefix + name)
        return F.coalesce(value, F.lit(0)) if name in zero_default else value

    # Insert what equals no version. The join hashes on all columns together, so
    # one customer with very many versions is spread over the partitions.
    known = snapshot.select([compared(c).alias("s_" + c) for c in columns]).distinct()
    equal = reduce(and_, [compared(c) == F.col("s_" + c) for c in columns])
    added = source.join(known, equal, "left_anti")

    # Close every version, new ones included, that differs from a source row of its key. Some
    # row differs in a column exactly when the least or the greatest value does, so one row of
    # extremes for each key stands for all its source rows, and no version meets more than one.
    others = [c for c in columns if c != key]
    extremes = (
        source.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("r_key"))
        .agg(
            *[F.min(compared(c)).alias(f"least_{c}") for c in others],
            *[F.max(compared(c)).alias(f"most_{c}") for c in others],
        )
    )
    differs = reduce(
        or_,
        [(compared(c) != F.col(f"{end}_{c}")) for c in others for end in ("least", "most")],
    )
    versions = snapshot.unionByName(_opened(added, columns, stamp))
    # Joined on the packed key, the extremes are shuffled once more, one row a key. Without that the join would stand on the
    # aggregation's own shuffle, and adaptive execution could not split a key with very many versions.
    met = versions.join(extremes, F.struct(key) == F.struct(F.col("r_key").alias(key)), "left")
    # A comparison with a null, or with no source row at all, closes nothing.
    outdated = F.coalesce(differs, F.lit(False))
    return met.select(
        *columns, "start_date", F.when(outdated, stamp).otherwise(F.col("end_date")).alias("end_date")
    )


def scd2_merge_in_place(
    versions: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    as_of: Column | str | None = None,
) -> DataFrame:
    """The ``null_safe`` merge of open ``versions`` with a source that has one row a key.

    It meets both sides on the key alone and sums by nothing else, so tables bucketed by the key are merged without a
    shuffle, and each version meets one row. A source with a key twice, or without one, fails the run.
    """
    stamp = as_of_column(as_of)
    packed = F.struct(*columns).alias("row")
    one = source.groupBy(F.col(key).alias("s_key")).agg(F.any_value(packed).alias("s_row"), F.count("*").alias("n"))
    fault = F.raise_error(F.format_string(f"source key {key} = %s: %d rows, one expected", F.col("s_key"), F.col("n")))
    sound = (F.col("n") == 1) & F.col("s_key").isNotNull()
    one = one.select("s_key", F.when(sound, F.col("s_row")).otherwise(fault).alias("s_row"))

    current = versions.filter("end_date is null").select(packed, "start_date", F.col(key).alias("v_key"))
    met = current.join(one, F.col("v_key") == F.col("s_key"), "left")
    same = F.col("row").eqNullSafe(F.col("s_row"))
    kept = met.select("row.*", "start_date", F.when(F.col("s_key").isNotNull() & ~same, stamp).alias("end_date"))

    # Found by a sum rather than a filter, which would make the rows themselves join keys and move them.
    known = met.groupBy("v_key").agg(F.bool_or(F.col("s_key").isNotNull() & same).alias("hit")).filter("hit")
    added = one.join(known, F.col("s_key") == F.col("v_key"), "left_anti").select("s_row.*")
    return kept.unionByName(_opened(added, columns, stamp))


def versions_at(history: DataFrame, moment: Column | str) -> DataFrame:
    """The versions that were valid at a moment: begun by then and not yet closed."""
    at = as_of_column(moment)
    return history.filter(
        (F.col("start_date") <= at) & (F.col("end_date").isNull() | (F.col("end_date") > at))
    )
