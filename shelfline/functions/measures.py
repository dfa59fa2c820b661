"""Exact ratios of counts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to here twice the numerator in millionths still fits in 64 bits.
_FAST_RATIO_LIMIT = 4 * 10**12


def exact_ratio(numerator: Column, denominator: Column | int) -> Column:
    """``numerator / denominator`` of whole numbers as ``decimal(38,6)``, rounded half up.

    Integer division in Spark yields a double, and decimal division works with 38
    digits whatever the operands are. Counts of ordinary size are therefore divided
    as whole millionths in 64 bits; anything else takes the decimal division, which
    gives the same value. A zero denominator gives null.
    """
    above = numerator.cast("bigint")
    below = (F.lit(denominator) if isinstance(denominator, int) else denominator).cast("bigint")
    ordinary = above.between(0, _FAST_RATIO_LIMIT) & below.between(1, _FAST_RATIO_LIMIT)
    millionths = F.call_function("div", above * 2_000_000 + below, below * 2)
    whole = T.DecimalType(38, 0)
    return F.when(
        ordinary, millionths.cast(T.DecimalType(19, 0)) * F.lit(Decimal("0.000001"))
    ).otherwise(numerator.cast(whole) / F.nullif(below.cast(whole), F.lit(0).cast(whole)))
