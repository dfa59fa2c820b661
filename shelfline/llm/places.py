"""Documents numbered in their order, so that a place in a text is one whole number.

A place is `no << bits | start`. Numbers follow doc_id, and the text's hash where an id repeats; rows without an id come
first. Rows that repeat id and text have one number. Where ids are whole numbers without nulls or repeats, a number is the
id's distance from the least; else rows are sorted by id and hash and counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.llm.scratch import written


def numbered(docs: DataFrame, bits: int) -> DataFrame:
    """(doc_id, no, text) of all rows, null texts empty. Raises where a number and `bits` don't fit into 63 bits."""
    text = F.coalesce("text", F.lit("")).alias("text")
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
        least, most, rows, held = ids.agg(F.min("doc_id"), F.max("doc_id"), F.count("*"), F.count("doc_id")).first()
        if not rows:
            return docs.select("doc_id", F.lit(0).cast("bigint").alias("no"), text)
        if rows == held and most - least < 1 << (63 - bits) and ids.groupBy("doc_id").count().filter("count > 1").isEmpty():
            return docs.select("doc_id", (F.col("doc_id").cast("bigint") - F.lit(least)).alias("no"), text)
    own = docs.select("doc_id", F.xxhash64(text).alias("h"), text)
    order = written(own.select("doc_id", "h").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "h").withColumn("_at", F.monotonically_increasing_id()))
    # The ids hold their partition's number above 33 bits; a row for each partition says how many come before it.
    part = F.shiftright("_at", 33)
    counts = sorted((r["part"], r["n"]) for r in order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, total = [], 0
    for k, n in counts:
        before.append((k, total))
        total += n
    if total >= 1 << (63 - bits):
        raise ValueError(f"{total} documents and {bits} bits for places don't fit together")
    offsets = docs.sparkSession.createDataFrame(before or [(0, 0)], "part bigint, before bigint")
    numbers = order.withColumn("part", part).join(offsets, "part")
    no = (F.col("before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias("no")
    numbers = numbers.select(F.col("doc_id").alias("of"), F.col("h").alias("of_h"), no)
    return written(own.join(numbers, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h"))).select("doc_id", "no", "text"))


def place(no: str, start: str, bits: int) -> Column:
    return F.shiftleft(F.col(no), bits) + F.col(start)


def no_of(at: str, bits: int) -> Column:
    return F.shiftright(F.col(at), bits)


def start_of(at: str, bits: int) -> Column:
    return F.col(at).bitwiseAND(F.lit((1 << bits) - 1))
