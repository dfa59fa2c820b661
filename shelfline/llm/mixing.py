"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources, in code-point order with null last, weigh 5, 2, 1 and so on, share all words by weight and
take at most three times their own, the excess going to the others. A source takes its documents
in whole epochs first; for the rest, each document gets an exponential key divided by its quality
weight, and in the order of keys documents are taken until the budget of words is reached (the one
at the border if that brings the sum closer).

The order never is made as a whole: sums of key ranges give the range where the budget ends, twice,
and only the documents of that small range are sorted. What remains is one cut for each source.

Null and empty texts have size 0 and add nothing. Keys come from a hash of doc_id and the letters'
share, so rows with the same id (or none) can have equal keys: those go by size, and of rows equal
in key, id and size, which are counted and not sorted, as many are taken as the budget takes, in
the order of the input. A null source is a source. An empty
table gives an empty mix. Other columns are carried, never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm import text as tx
from shelfline.llm.scratch import written

WEIGHTS, MOST_EPOCHS, SEED, RANGES = (5, 2, 1), 3, 11, 256


def _key(text: Column, doc_id: Column) -> Column:
    """An exponential variate over the document's quality weight: 0.5 and the letters' share of the words."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13), 16, 10)
    uniform = (digits.cast("double") + 0.5) / 2.0**52
    text = F.coalesce(text, F.lit(""))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    share = letters / F.greatest(F.length(F.translate(text, " \t\n\x0b\f\r", "")), F.lit(1))
    return -F.log(uniform) / (0.5 + share)


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` as `_row`; source, size, sampling key and a number of the row, which holds once they are stored."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_source"),
        F.size(tx.words(F.col("text"))).cast("long").alias("size"),
        _key(F.col("text"), F.col("doc_id")).alias("_key"),
        F.monotonically_increasing_id().alias("_serial"),
    )


def targets(sizes: DataFrame) -> DataFrame:
    """_source, source_size, target: one row for each source. The windows go over sources, not documents."""
    by_name = W.orderBy(F.col("_source").asc_nulls_last())
    weights = F.array(*map(F.lit, WEIGHTS))
    df = sizes.groupBy("_source").agg(F.sum("size").alias("source_size"))
    df = df.withColumn("i", F.row_number().over(by_name) - 1)
    df = df.withColumn("w", F.get(weights, (F.col("i") % len(WEIGHTS)).cast("int")).cast("long"))
    df = df.withColumn("cap", MOST_EPOCHS * F.col("source_size"))
    # In the order of cap over weight: those before a source reach their caps before it does.
    order = W.orderBy(F.col("cap") / F.col("w"), "i")
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    df = df.withColumns({"at": F.row_number().over(order), "per_weight": left / weight_left})
    below = F.when(F.col("w") * F.col("per_weight") <= F.col("cap"), F.col("at"))
    df = df.withColumn("free", F.min(below).over(everything))
    per_weight = F.max(F.when(F.col("at") == F.col("free"), F.col("per_weight"))).over(everything)
    target = F.when(F.col("at") < F.col("free"), F.col("cap").cast("double")).otherwise(F.col("w") * per_weight)
    return df.select("_source", "source_size", target.alias("target"))


def _range(n: int) -> Column:
    """Which of n ranges of keys, in their order."""
    return F.floor((1 - F.exp(-F.col("_key"))) * n)


def _part(serial: str) -> Column:
    """The input partition of a row's number."""
    return F.shiftright(serial, 33)


def _last(rows: DataFrame, open_: DataFrame) -> DataFrame:
    """(_of, cut): per source the last row that the budget takes, of the rows in its range. Equal rows count as one with a number."""
    same = F.col("_source").eqNullSafe(F.col("_of"))
    equal = rows.groupBy("_source", "_key", "_id", "size").agg(F.count("*").alias("n"))
    order = W.partitionBy("_source").orderBy("_key", "_id", "size")
    before = F.sum(F.col("n") * F.col("size")).over(order) - F.col("n") * F.col("size")
    # The k-th of equal rows is taken if its middle is within the budget.
    most = F.floor((2 * (F.col("budget") - before) + F.col("size")) / (2 * F.col("size")))
    ends = (
        equal.join(open_.select(F.col("_source").alias("_of"), "budget"), same)
        .withColumn("take", F.least(F.col("n"), most)).filter("take > 0")
        .groupBy("_of").agg(F.max(F.struct("_key", "_id", "size", "take")).alias("end"))
    )
    # The number of the last row: by counts of input partitions, then within one of them.
    border = rows.join(ends, same & (F.col("_key") == F.col("end._key")) & F.col("_id").eqNullSafe(F.col("end._id")) & (F.col("size") == F.col("end.size")))
    border = written(border.select("_of", "_serial", _part("_serial").alias("part"), "end"))
    parts = border.groupBy("_of", "part").agg(F.count("*").alias("n"), F.any_value("end.take").alias("take"))
    parts = parts.withColumn("upto", F.sum("n").over(W.partitionBy("_of").orderBy("part")))
    parts = parts.filter((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take")))
    parts = parts.select(F.col("_of").alias("of"), F.col("part").alias("of_part"), (F.col("take") - F.col("upto") + F.col("n")).alias("number"))
    there = border.join(parts, F.col("_of").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
    there = there.withColumn("i", F.row_number().over(W.partitionBy("_of").orderBy("_serial"))).filter("i = number")
    return there.select("_of", F.struct("end._key", "end._id", "end.size", "_serial").alias("cut"))


def cuts(sizes: DataFrame) -> DataFrame:
    """Per source: target, whole epochs, the key range where the fractional epoch ends, its last key (id, size and number) there."""
    goal = targets(sizes)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = written(
        goal.withColumn("epochs", whole).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    rows = sizes.filter("size > 0").select(
        "_id", "_source", "size", "_key", "_serial", _range(RANGES).alias("coarse"), _range(RANGES * RANGES).alias("fine"))
    open_, same = goal.select("_source", "budget").filter("budget > 0"), F.col("_source").eqNullSafe(F.col("_of"))
    for level in ("coarse", "fine"):
        df = rows.join(open_.withColumnRenamed("_source", "_of"), same).groupBy("_source", level, "budget").agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(W.partitionBy("_source").orderBy(level))
        df = df.withColumn("upto", upto).filter("upto >= budget")
        open_ = written(
            df.groupBy("_source").agg(F.min_by(F.struct(level, (F.col("budget") - F.col("upto") + F.col("n")).alias("budget")), level).alias("x"))
            .select("_source", "x.*")
        )
        there = open_.select(F.col("_source").alias("_of"), F.col(level).alias("_level"))
        rows = rows.join(there, same & (F.col(level) == F.col("_level"))).drop("_of", "_level")
    last = _last(rows, open_)
    ends = open_.select(F.col("_source").alias("_of"), F.col("fine").alias("end"))
    goal = goal.join(ends, same, "left").drop("_of").join(last, same, "left")
    return written(goal.select("_source", "source_size", "target", "epochs", "end", "cut"))


def mixed(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` as `_row`, with size, source_size, target and copies (how often the mix takes the document)."""
    rows = written(_measured(docs, keep))
    cut = cuts(rows.drop("_row")).withColumnRenamed("_source", "_of")
    taken = (_range(RANGES * RANGES) < F.col("end")) | (F.struct("_key", "_id", "size", "_serial") <= F.col("cut"))
    part = F.coalesce(taken, F.lit(False)).cast("long")
    copies = F.when(F.col("size") > 0, F.col("epochs") + part).otherwise(0)
    return rows.join(cut, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
        "_row", "size", "source_size", "target", copies.alias("copies"))


def shares(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target and the words taken."""
    df = mixed(docs, ["doc_id"])
    return df.select("_row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns."""
    df = mixed(docs, docs.columns).filter("copies > 0")
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def oracle() -> str:
    """Every document's place in the order of its source, by plain windows."""
    return rf"""
with d as (
  select doc_id, source, coalesce(text, '') as t,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    (('0x' || md5('{SEED}:' || coalesce(doc_id::varchar, ''))[1:13])::bigint::double + 0.5) / pow(2, 52) as u
  from documents
), k as (
  select *, -ln(u) / (0.5 + length(regexp_replace(t, '\P{{L}}+', '', 'g')) / greatest(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')), 1)) as key from d
), s as (
  select source, sum(size)::bigint as source_size from d group by source
), w as (
  select *, {MOST_EPOCHS} * source_size as cap, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as w,
    row_number() over (order by source nulls last) as i from s
), o as (
  select *, row_number() over (order by cap / w, i) as place,
    (sum(source_size) over () - coalesce(sum(cap) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(w) over () - coalesce(sum(w) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0))::double as per_weight
  from w
), f as (
  select min(place) as free, arg_min(per_weight, place) as per_weight from o where w * per_weight <= cap
), g as (
  select source, source_size, case when place < free then cap::double else w * f.per_weight end as target from o, f
), h as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from g
), p as (
  select k.doc_id, size, source_size, target, epochs, target - epochs * source_size as budget,
    sum(size) over (partition by k.source order by key, doc_id rows between unbounded preceding and current row) as upto
  from k join h on k.source is not distinct from h.source
)
select doc_id, size::bigint as size, source_size, target,
  (size * (epochs + case when budget > 0 and 2 * upto - size <= 2 * budget then 1 else 0 end))::bigint as taken
from p"""
