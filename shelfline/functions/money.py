"""Sums of money that are exact and do not depend on the order of the rows.

Decimal and whole amounts are summed as whole units of their own scale in a 64-bit integer: one machine word instead of a
128-bit decimal, so partial aggregation runs about as fast as a plain ``sum(bigint)`` and shuffles half the bytes.

A double has no scale. It is cut into limbs: whole numbers of 30 bits, each with its own power of two as unit, that add up
to the amount. Limbs are summed as integers; sums of sums are sums of limbs again, so any number of levels of aggregation
stays exact. Once at the end the limbs are carried into digits and rounded to the nearest double. That takes amounts below
2^63 in size, down to bits of 2^-87; smaller bits are rounded off row by row. Not-a-number, infinity and larger amounts are
kept beside the limbs and added as doubles, so they show in the total and stop nothing.

Either way a total that does not fit into its integers raises under ANSI mode instead of wrapping.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDTH = 30
# Units of the limbs as powers of two, greatest first; the first limb takes what is above, too.
_UNITS = (33, 3, -27, -57, -87)
_LARGE = float(2**63)


@dataclass(frozen=True)
class Money:
    """How amounts are carried into sums: as whole units of ``10**-scale``, or as limbs where ``scale`` is None.

    An amount in a sum is held in one or several columns, ``parts``, that are summed one by one.
    """

    scale: int | None

    def amount(self, df: DataFrame, name: str) -> Column:
        """The money column as whole units, or as a double."""
        if self.scale is None:
            return F.col(name).cast("double")
        return (F.col(name) * F.lit(10**self.scale)).cast("bigint")

    def names(self, name: str) -> list[str]:
        return [name] if self.scale is not None else [f"{name}_{k}" for k in range(len(_UNITS) + 1)]

    def parts(self, amount: Column, name: str) -> list[Column]:
        """The columns that stand for an amount in sums."""
        if self.scale is not None:
            return [amount.alias(name)]
        ordinary = F.abs(amount) < _LARGE  # false for not-a-number, which is above all numbers
        held = F.when(ordinary, amount)
        limbs = [(held * F.lit(2.0 ** -_UNITS[0])).cast("bigint")]
        for unit in _UNITS[1:]:
            # Scaling by a power of two and the remainder are exact; the sign is that of the amount.
            rest = (held * F.lit(2.0**-unit)) % F.lit(2.0**_WIDTH)
            limbs.append((F.rint(rest) if unit == _UNITS[-1] else rest).cast("bigint"))
        beside = F.when(~ordinary, amount)
        return [c.alias(n) for c, n in zip([*limbs, beside], self.names(name), strict=True)]

    def nothing(self, name: str) -> list[Column]:
        """Parts of no amount, for rows that take part in other sums."""
        kinds = ["bigint"] * (len(self.names(name)) - 1) + ["bigint" if self.scale is not None else "double"]
        return [F.lit(None).cast(k).alias(n) for k, n in zip(kinds, self.names(name), strict=True)]

    def sums(self, name: str, amount: Column | None = None) -> list[Column]:
        """Aggregates that sum an amount, or parts that were made or summed before."""
        if amount is None:
            return [F.sum(n).alias(n) for n in self.names(name)]
        return [F.sum(part).alias(n) for part, n in zip(self.parts(amount, name), self.names(name), strict=True)]

    def scaled(self, name: str, times: Column) -> list[Column]:
        """Summed parts times a whole number."""
        return [(F.col(n) * times).alias(n) for n in self.names(name)]

    def minus(self, name: str, less: str) -> list[Column]:
        """Summed parts minus those of another amount, which is null where either is."""
        if self.scale is not None:
            return [(F.col(name) - F.col(less)).alias(name)]
        both = ~(_is_missing(self, name) | _is_missing(self, less))
        zeros = [(F.coalesce(F.col(a), F.lit(0)) - F.coalesce(F.col(b), F.lit(0)), a) for a, b in zip(self.names(name), self.names(less), strict=True)]
        return [F.when(both, c).alias(n) for c, n in zeros]

    def decimal(self, name: str) -> Column:
        """A total: exact decimal for whole units, nearest double for limbs."""
        if self.scale is None:
            return _nearest(self, name)
        whole = F.col(name).cast(T.DecimalType(20, 0))
        return whole if self.scale == 0 else whole * F.lit(Decimal(1).scaleb(-self.scale))

    def double(self, name: str) -> Column:
        """A total as the nearest double, for columns declared FLOAT."""
        if self.scale is None:
            return _nearest(self, name)
        # Both are exact up to 2^53 and 10^22, so one division rounds once; longer totals go by the decimal's digits.
        quotient = F.col(name).cast("double") / F.lit(float(10**self.scale))
        return F.when(F.abs(F.col(name)) <= 2**53, quotient).otherwise(self.decimal(name).cast("string").cast("double"))


#: Doubles in sums.
LIMBS = Money(None)


def money(df: DataFrame, *names: str) -> Money:
    """How the named money columns are summed together: by the largest scale, or as limbs if one is a double."""
    scales = []
    for name in names:
        kind = df.schema[name].dataType
        if not isinstance(kind, (T.DecimalType, T.IntegralType)):
            return LIMBS
        scales.append(kind.scale if isinstance(kind, T.DecimalType) else 0)
    return Money(max(scales))


def together(*ways: Money) -> Money:
    """One way for amounts that are summed together."""
    scales = [w.scale for w in ways]
    return LIMBS if None in scales else Money(max(scales))


def _is_missing(way: Money, name: str) -> Column:
    limb, beside = way.names(name)[0], way.names(name)[-1]
    return F.col(limb).isNull() & F.col(beside).isNull()


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _carried(limbs: list[Column]) -> list[Column]:
    """Limbs with all but the first brought into 0 .. 2^30 - 1."""
    out, carry = [], None
    for limb in reversed(limbs[1:]):
        limb = limb if carry is None else limb + carry
        out.append(limb.bitwiseAND(F.lit((1 << _WIDTH) - 1)))
        carry = F.shiftright(limb, _WIDTH)
    return [limbs[0] + carry, *reversed(out)]


def _rounded(digits: Column) -> Column:
    """The nearest double of non-negative digits, the first of which may be long."""
    mask = F.lit((1 << _WIDTH) - 1)
    first = F.get(digits, F.lit(0))
    # The first digit has 63 bits: three digits of 30.
    spread = F.concat(
        F.array(F.shiftright(first, 2 * _WIDTH), F.shiftright(first, _WIDTH).bitwiseAND(mask), first.bitwiseAND(mask)),
        F.slice(digits, 2, len(_UNITS) - 1),
        F.array(*[F.lit(0).cast("bigint")] * 3),
    )
    places = len(_UNITS) + 2
    # The unit of the digit behind the leading one.
    units = F.array(*[F.lit(2.0 ** (_UNITS[0] + _WIDTH * (1 - k))) for k in range(places + 1)])

    def from_lead(d: Column) -> Column:
        def at(k: Column) -> Column:
            p, q, r = (F.get(d, k + i) for i in range(3))
            more = F.greatest(F.lit(0), *[F.coalesce(F.get(d, k + i), F.lit(0)) for i in range(3, places)])
            # 62 leading bits, the last of which says whether anything follows; an integer rounds once to a double.
            shift = F.least(F.lit(_WIDTH), F.lit(_WIDTH + 2) - F.length(F.bin(p))).cast("int")
            cut = F.lit(_WIDTH) - shift
            head = F.call_function("shiftleft", F.shiftleft(p, _WIDTH) + q, shift) + F.call_function("shiftright", r, cut)
            rest = r.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), cut) - 1) + more
            sticky = head.bitwiseOR(F.when(rest > 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
            scale = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift).cast("double")
            return F.when(p == 0, F.lit(0.0)).otherwise(sticky.cast("double") / scale * F.get(units, k))

        lead = F.coalesce(*[F.when(F.get(d, F.lit(k)) != 0, F.lit(k)) for k in range(places)], F.lit(0))
        return _let(lead, at)

    return _let(spread, from_lead)


def _nearest(way: Money, name: str) -> Column:
    """The nearest double of summed limbs, with what is beside them."""
    *limbs, beside = [F.col(n) for n in way.names(name)]

    def signed(digits: Column) -> Column:
        below = F.get(digits, F.lit(0)) < 0
        turned = F.array(*_carried([-F.get(digits, F.lit(k)) for k in range(len(_UNITS))]))
        return F.when(below, -_rounded(turned)).otherwise(_rounded(digits))

    total = _let(F.array(*_carried([F.coalesce(c, F.lit(0)) for c in limbs])), signed)
    total = F.when(beside.isNull(), F.when(limbs[0].isNotNull(), total)).otherwise(total + beside)
    # What lies in the second and third limb alone, as dyadic amounts of ordinary size do, is one integer, and its cast rounds once, too.
    high, low = limbs[1], limbs[2]
    ordinary = beside.isNull() & (limbs[0] == 0) & (limbs[3] == 0) & (limbs[4] == 0)
    ordinary &= high.between(-(2**31), 2**31) & low.between(-(2**61), 2**61)
    return F.when(ordinary, (high * (1 << _WIDTH) + low).cast("double") * F.lit(2.0 ** _UNITS[2])).otherwise(total)

