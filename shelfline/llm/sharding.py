"""Sharding by extendible hashing.

A document's key hashes to a string of bits; a shard holds all documents whose bits begin with its
prefix. Only a bucket beyond the byte limit splits, on its next bit. The directory is found from
byte sums of STEP-bit prefixes, so a round handles STEP bits of depth in one pass over (bits, bytes),
and the next looks only at prefixes that are still too large.

Bits come from md5 of doc_id and then from a hash of the text. Rows that agree in both are the same,
so no bit tells them apart: such a bucket overflows into pages of its own, cut at the limit by the
number of rows. A document larger than the limit is a shard by itself.

Null texts have 0 bytes, null ids hash as the empty string. Repeated rows count each. An empty table
gives no shards. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.scratch import written

STEP, LIMIT = 12, 32 << 20
BITS = 128


def _bits(doc_id: Column, text: Column) -> Column:
    """64 bits of the id's md5, then 64 bits of the text's hash, as a string of 0 and 1."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    halves = [F.lpad(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 2), 32, "0") for k in range(2)]
    return F.concat(*halves, F.lpad(F.bin(F.xxhash64(text)), 64, "0"))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` as `_row`, the text's size, and the bits."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), size.alias("n_bytes"), _bits(F.col("doc_id"), F.col("text")).alias("bits"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """(prefix, shard_bytes, shard_docs) of every shard; those still too large have all BITS."""
    shards, at = None, 0
    left = rows.select("bits", "n_bytes")
    while True:
        upto = min(at + STEP, BITS)
        sums = left.groupBy(F.substring("bits", 1, upto).alias("long")).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
        depths = F.sequence(F.lit(at), F.lit(upto))
        tree = (
            sums.withColumn("depth", F.explode(depths))
            .groupBy(F.expr("substring(long, 1, depth)").alias("prefix")).agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        )
        tree = written(tree)
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.length("prefix") == BITS)
        parents = tree.filter(~fits).select(F.col("prefix").alias("parent"))
        parent = F.expr("substring(prefix, 1, length(prefix) - 1)")
        whole = tree.filter(fits & (F.length("prefix") > at)).withColumn("parent", parent).join(parents, "parent", "left_semi").drop("parent")
        if at == 0:
            whole = whole.unionByName(tree.filter(fits & (F.length("prefix") == 0)))
        shards = whole if shards is None else shards.unionByName(whole)
        open_ = parents.filter(F.length("parent") == upto)
        if upto == BITS or open_.isEmpty():
            return written(shards)
        left = left.join(open_, F.substring("bits", 1, upto) == F.col("parent"), "left_semi")
        at = upto


def dealt(docs: DataFrame, keep: list[str], limit: int) -> DataFrame:
    """Per row of docs: the columns `keep` as `_row`, n_bytes, shard (its bits, and the page if it overflows), depth, shard_bytes, shard_docs."""
    rows = written(measured(docs, keep).withColumn("part", F.spark_partition_id()))
    found = directory(rows, limit)
    # Pages of buckets that no bit can split: a row's number among its equals, counted within and then over input parts.
    full = found.filter((F.length("prefix") == BITS) & (F.col("shard_bytes") > limit) & (F.col("shard_docs") > 1))
    same = rows.join(full.select(F.col("prefix").alias("bits")), "bits", "left_semi")
    per_part = same.groupBy("bits", "part").agg(F.count("*").alias("here"))
    before = per_part.withColumn("before", F.sum("here").over(W.partitionBy("bits").orderBy("part")) - F.col("here")).drop("here")
    number = F.row_number().over(W.partitionBy("bits", "part").orderBy("n_bytes")) - 1 + F.col("before")
    rows_a_page = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    paged = same.join(before, ["bits", "part"]).withColumn("page", F.floor(number / rows_a_page))
    pages = paged.withColumn("shard", F.concat("bits", F.lit("+"), F.col("page").cast("string")))
    page_sums = pages.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_docs"))
    names = ["_row", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs"]
    over = pages.withColumn("depth", F.lit(BITS)).join(page_sums, "shard").select(names)

    # A prefix is found by trying the depths that occur, at most BITS + 1 however many shards there are.
    single = rows.join(full.select(F.col("prefix").alias("bits")), "bits", "left_anti")
    depths = [r[0] for r in found.select(F.length("prefix")).distinct().collect()]
    tried = single.withColumn("depth", F.explode(F.array(*map(F.lit, depths or [0]))))
    tried = tried.withColumn("prefix", F.expr("substring(bits, 1, depth)"))
    return tried.join(found, "prefix").withColumnRenamed("prefix", "shard").select(names).unionByName(over)


def shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, shard, depth, shard_bytes, shard_docs."""
    return dealt(docs, ["doc_id"], limit).select("_row.doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs")


def write(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """docs as Parquet, one folder for each shard: every row in the one that it was dealt to, page included."""
    dealt(docs, docs.columns, limit).select("_row.*", "shard").repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = LIMIT, most: int = 40) -> str:
    """By the sums of every prefix of the ids' hashes, enough bits for distinct ids."""
    return f"""
with d as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
    list_reduce(list_transform(range(0, {most // 4}), lambda i: right(bin(('0x' || md5(doc_id::varchar)[i + 1])::int + 16), 4)), lambda a, b: a || b) as bits
  from documents
), p as (
  select doc_id, n_bytes, k as depth, bits[1:k] as shard from d, range(0, {most} + 1) t(k)
), s as (
  select *, sum(n_bytes) over (partition by shard)::bigint as shard_bytes, count(*) over (partition by shard) as shard_docs from p
)
select doc_id, n_bytes, shard, depth::int as depth, shard_bytes, shard_docs from s
where shard_bytes <= {limit} or shard_docs = 1
qualify row_number() over (partition by doc_id order by depth) = 1"""
