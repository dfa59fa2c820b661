"""Row order along several columns at once.

Rows sorted by (a, b) let a reader skip by a, but hardly by b alone. Sorted by the interleaved bits of both columns' places
they form blocks that are narrow in each column, and the least and greatest values that Parquet keeps for a block serve
a filter on any of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edges(df: DataFrame, columns: Sequence[str], bits: int = 6) -> dict[str, list]:
    """Per column at most ``2 ** bits - 1`` values, in order, that cut its rows into shares of like size; a frequent value is one edge.

    One aggregate over ``df``, which may well be a dimension that holds the keys rather than the rows themselves.
    """
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, shares).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def place(column: Column, cuts: list, bits: int) -> Column:
    """How many of the ordered ``cuts`` are not above the value, by halving; 0 for null."""
    if not cuts:
        return F.lit(0)
    table = F.array(*map(F.lit, cuts))

    def halve(at: Column, bit: Column) -> Column:
        step = F.call_function("shiftright", F.lit(2 ** (bits - 1)), bit)
        return F.when(F.get(table, at + step - 1) <= column, at + step).otherwise(at)

    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0), halve)


def interleaved(cuts: Mapping[str, list], bits: int = 6) -> Column:
    """A whole number to sort by: the bits of the columns' places in turn, highest first, the first column's before the others'."""
    if len(cuts) * bits > 62:
        raise ValueError("the places need more than 62 bits")
    number = F.lit(0).cast("bigint")
    for at, (name, values) in enumerate(cuts.items()):
        where = place(F.col(name), values, bits).cast("bigint")
        for b in range(bits):
            number = number.bitwiseOR(F.shiftleft(F.shiftright(where, b).bitwiseAND(F.lit(1).cast("bigint")), b * len(cuts) + len(cuts) - 1 - at))
    return number
