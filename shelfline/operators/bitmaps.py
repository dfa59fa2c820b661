"""Exact distinct counts that can be merged.

A state holds, for each group and each range of 64 whole numbers, one 64-bit word of the numbers seen. States of different days
are merged by ``or``, so a new day is counted without reading the earlier ones again, and repeats between days count once. A
row has a few bytes however few bits are set, so a state never has more rows than its numbers, and up to 64 times fewer where
they are dense. Words are summed up in hash tables of fixed-size rows: nothing is sorted, and no row grows when it is unpacked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD, BITS = "word", "bits"


def distinct_state(df: DataFrame, groups: Sequence[str], number: str) -> DataFrame:
    """(groups, word, bits) of the non-null whole numbers in a column. Words are filled in the tasks and merged after."""
    value = F.col(number).cast("bigint")
    place = value.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    return df.filter(F.col(number).isNotNull()).groupBy(*groups, F.shiftright(value, 6).alias(WORD)).agg(F.bit_or(bit).alias(BITS))


def merged_states(states: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row for each group and word, whatever the number of states that hold it."""
    return states.groupBy(*groups, WORD).agg(F.bit_or(BITS).alias(BITS))


def distinct_counts(states: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """(groups, name): how many distinct numbers each group has over all its states."""
    counts = merged_states(states, groups).groupBy(*groups)
    return counts.agg(F.sum(F.bit_count(BITS)).alias(name))
