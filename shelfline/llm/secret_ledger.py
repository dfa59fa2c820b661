"""Secret scans with a ledger of content-addressed blobs, in DataFrame expressions only.

Every text, of whatever version of whatever document, is a blob named by its SHA-256. The ledger
has a row for each blob and rule version that was scanned, with its findings. A scan reads only
blobs that the ledger lacks under the present rules, one row for each however many documents share
it; a report joins the findings back to all rows.

Null and empty texts are one blob without findings. Repeated rows are reported one by one. An empty
table gives an empty ledger and report. Long texts and texts with many findings are scanned whole: the
offsets of n findings take n times GROUP steps. Documents' other columns are carried, never read, so they
may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.scratch import written

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
LEDGER = f"blob string, rule_version string, findings {SPAN}"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """A finding is head and value, the value of at least `least` characters. hint: what texts without a finding lack."""

    kind: str
    head: str
    value: str
    least: int
    hint: str

    @property
    def pattern(self) -> str:
        return f"({self.head})({self.value})"


# The patterns. The first three are the base kinds, the others add to them.
KEYWORD = _either_case("password|passwd|secret|token|api_?key")
ASSIGN_HEAD = f"""(?:{KEYWORD})["']?\\x20*[:=]\\x20*["']?"""
RULES = (
    Rule("assign", ASSIGN_HEAD, "[A-Za-z0-9+/_.=-]+", 6, ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]{6}"),
    Rule("access", "", "AKIA[A-Z0-9]+", 20, "AKIA[A-Z0-9]{16}"),
    Rule("hex", "", "[0-9a-f]+", 24, "[0-9a-f]{24}"),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]"),
    Rule("key_block", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 27, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = 3
#: Findings whose lengths are added up together.
GROUP = 128
VERSION = "3"
REDACTED = "[REDACTED]"
# What follows a private key's BEGIN, up to the next: all through END, or without it header and base64 lines.
BEGIN, KEY_END = "-----BEGIN ", r"\A[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----"
BREAK = r"[ \t]*+(?:\r|\\r)?+(?:\n|\\n)?+[ \t]*+"
KEY_LINE = r"(?:[A-Za-z0-9+/]{32,}+=*+|[A-Za-z0-9+/]++=*+(?=[ \t]*+(?:[\r\n]|\\[rn]|\z)))"
KEY_LINES = rf"\A(?:(?:\s|\\[rn])*+(?:Proc-Type|DEK-Info):[^\n]*+)*+(?:(?:\s|\\[rn])*+{KEY_LINE}(?:{BREAK}{KEY_LINE})*+)?"


def _let(value: Column, then) -> Column:
    """then(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _before(lengths: Column) -> Column:
    """How much comes before each of some lengths: sums within groups of GROUP, on top of the sums of the groups before."""
    groups = F.sequence(F.lit(0), F.call_function("div", F.size(lengths) - 1, F.lit(GROUP)).cast("int"))

    def total(low: Column, n) -> Column:
        return F.aggregate(F.slice(lengths, low + 1, n), F.lit(0), lambda a, b: a + b)

    def step(seen: Column, g: Column) -> Column:
        return F.struct((seen["at"] + total(g * GROUP, F.lit(GROUP))).alias("at"), F.array_append(seen["bases"], seen["at"]).alias("bases"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases"))
    bases = F.aggregate(groups, start, step, lambda seen: seen["bases"])

    def within(base: Column, g: Column) -> Column:
        last = F.least(F.lit(GROUP), F.size(lengths) - g * GROUP) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda k: base + total(g * GROUP, k))

    return F.flatten(F.transform(bases, within))


def _spans(rule: Rule, rank: int, text: Column) -> Column:
    """Leftmost non-overlapping findings with code-point offsets.

    The text is cut where findings start, with marks behind head and value; adding up lengths gives
    the offsets. Marks in the text itself are first replaced by another control character, which no
    pattern holds either.
    """
    for mark in "\x01\x02\x03":
        text = F.replace(text, F.lit(mark), F.lit("\x04"))
    parts = F.split(F.regexp_replace(text, rule.pattern, "\x01$1\x02$2\x03"), "\x01")

    def found(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p, k: F.length(p) - F.when(k > 0, F.lit(2)).otherwise(F.lit(0)))

        def spans(before: Column) -> Column:
            def span(part: Column, k: Column) -> Column:
                head = F.locate("\x02", part) - 1
                value = F.locate("\x03", part) - head - 2
                start = F.get(before, k + 1)
                ends = F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + head + value).alias("end"), F.lit(rule.kind).alias("kind"))
                return F.when(value >= rule.least, ends)

            return F.array_compact(F.transform(F.slice(parts, 2, F.size(parts)), span))

        return _let(_let(lengths, _before), spans)

    return F.when(F.col("text").rlike(rule.hint), _let(parts, found)).otherwise(F.array()).cast(SPAN)


def findings() -> Column:
    """All spans of column `text`, by start, then kind."""
    spans = [_spans(rule, rank, F.col("text")) for rank, rule in enumerate(RULES)]
    return F.sort_array(F.concat(*spans)).cast(SPAN)


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """The ledger's new rows: each unseen blob of docs, scanned once under the present rules."""
    rows = docs.select(
        blob(F.col("text")).alias("blob"),
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("at"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    seen = ledger.filter(F.col("rule_version") == VERSION).select("blob")
    unseen = rows.groupBy("blob").agg(F.min("at").alias("at")).join(seen, "blob", "left_anti")
    found = rows.join(unseen, ["blob", "at"]).select("blob", findings().alias("findings"))
    return found.dropDuplicates(["blob"]).select("blob", F.lit(VERSION).alias("rule_version"), "findings")


def update(docs: DataFrame, path: str) -> DataFrame:
    """Append what is new in docs to the ledger stored at `path`, and return the whole ledger."""
    spark = docs.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    ledger = spark.read.schema(LEDGER).parquet(path) if there else empty_ledger(spark)
    scan(docs, ledger).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _found(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """rows (with column blob) and the findings of each."""
    # Runs at the same time may have scanned the same blob; their findings are equal.
    present = ledger.filter(F.col("rule_version") == VERSION).select("blob", "findings").dropDuplicates(["blob"])
    return rows.join(present, "blob", "left")


def report(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, counts of the base kinds, digest of base spans, all spans."""
    rows = _found(docs.select("doc_id", blob(F.col("text")).alias("blob")), ledger)

    def named(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(rank: int) -> Column:
        return F.size(F.filter("findings", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(RULES[:BASE])]
    base = F.filter("findings", lambda s: s["rank"] < BASE)
    return rows.select("doc_id", *counts, F.sha2(named(base), 256).alias("base_sha256"), named(F.col("findings")).alias("spans"))


def _secret_end(text: Column, span: Column) -> Column:
    """Where the secret of a span ends: a key block's span is its BEGIN only, its secret what follows."""
    rest = F.substring_index(F.substring(text, span["end"] + 1, F.length(text)), BEGIN, 1)
    whole = F.regexp_extract(rest, KEY_END, 0)
    body = F.when(whole != "", whole).otherwise(F.regexp_extract(rest, KEY_LINES, 0))
    return F.when(span["kind"] == "key_block", span["end"] + F.length(body)).otherwise(span["end"])


def redacted(docs: DataFrame, ledger: DataFrame) -> DataFrame:
    """docs with every finding in `text` replaced (private keys through their END) and `n_chars`, where there is one, counted anew."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), blob(F.col("text")).alias("blob"))
    text = F.col("_row.text")

    def step(done: Column, span: Column) -> Column:
        before = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        out = F.when(span["start"] >= done["at"], F.concat(done["out"], before, F.lit(REDACTED))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], _secret_end(text, span)).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cut = F.aggregate("findings", start, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    new = F.when(F.size("findings") > 0, cut).otherwise(text)
    kinds = dict(docs.dtypes)
    columns = []
    for c in docs.columns:
        column = F.col(f"_row.`{c}`")
        if c == "text":
            column = F.col("_new")
        elif c == "n_chars":
            column = F.when(F.size("findings") > 0, F.length("_new").cast(kinds[c])).otherwise(column)
        columns.append(column.alias(c))
    return _found(rows, ledger).withColumn("_new", new).select(columns)


def scrub(docs: DataFrame) -> DataFrame:
    """docs without secrets, by a ledger of their own."""
    return redacted(docs, written(scan(docs, empty_ledger(docs.sparkSession))))


# Oracle: each kind's matches are marked in the same way and their places added up row by row.
def oracle() -> str:
    kinds, patterns = [r.kind for r in RULES], [r.pattern.replace("'", "''") for r in RULES]
    parts = " union all ".join(
        f"select doc_id, {k} as rank, '{kind}' as kind, {RULES[k].least} as least, "
        f"string_split(regexp_replace(t, '{patterns[k]}', chr(1) || '\\1' || chr(2) || '\\2' || chr(3), 'g'), chr(1)) as p from safe"
        for k, kind in enumerate(kinds)
    )
    counts = ", ".join(f"count(s.kind) filter (where s.rank = {k}) as n_{kinds[k]}" for k in range(BASE))
    name = "s.kind || ':' || s.first || ':' || (s.first + s.found)"
    return f"""
with safe as (
  select doc_id, replace(replace(replace(coalesce(text, ''), chr(1), chr(4)), chr(2), chr(4)), chr(3), chr(4)) as t from documents
), cut as ({parts}
), piece as (
  select doc_id, rank, kind, least, unnest(p) as piece, unnest(range(len(p))) as i from cut
), placed as (
  select *, length(piece) - if(i = 0, 0, 2) as n,
    coalesce(sum(length(piece) - if(i = 0, 0, 2)) over (partition by doc_id, rank order by i rows between unbounded preceding and 1 preceding), 0)::bigint as first,
    instr(piece, chr(2)) - 1 as head, instr(piece, chr(3)) - instr(piece, chr(2)) - 1 as value
  from piece
), s as (
  select doc_id, rank, kind, first, head + value as found from placed where i > 0 and value >= least
)
select d.doc_id, {counts},
  sha256(coalesce(string_agg({name}, ',' order by s.first, s.rank) filter (where s.rank < {BASE}), '')) as base_sha256,
  coalesce(string_agg({name}, ',' order by s.first, s.rank), '') as spans
from documents d left join s using (doc_id) group by d.doc_id"""
