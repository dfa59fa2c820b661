"""Column expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space between words, and the ASCII letters folded to lower case.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The maximal runs without white space; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def shingle_hashes(words_of: Column, size: int) -> Column:
    """A 64-bit hash of each run of `size` words; of the whole sequence if it is shorter, none without words."""
    n = F.size(words_of)
    runs = F.transform(
        F.sequence(F.lit(0), n - size),
        lambda i: F.xxhash64(*[F.get(words_of, i + k) for k in range(size)]),
    )
    short = F.array(F.xxhash64(F.lit(size), F.array_join(words_of, " ")))
    return F.when(n >= size, runs).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))
