"""Quality rules by weak supervision, in DataFrame expressions only.

Each rule votes good (1), bad (-1) or abstains (0). Expectation-maximisation over the counts of
vote patterns (3 to the number of rules at most, whatever the corpus) estimates how often each rule
votes each way on good and on bad documents, and a document is kept if its posterior probability of
being good reaches the threshold. Texts that break the base rules are never kept.

Null and empty texts have no words: every count is 0, `base_failed` is true, `kept` false. Repeated
rows are judged alike, each for itself. An empty table gives an empty result. Only `text` (and the
columns asked for) is read, so other columns may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import text as tx
from shelfline.llm.scratch import written

# Characters that count as symbols, and frequent words of four languages.
SYMBOLS = "#*$%&|<>"
COMMON_WORDS = (
    "the of and to in is that it for was on are as with be by this from at or an "
    "le la les des et en un une du que qui dans pour pas sur "
    "der die das und ein eine ist nicht mit den von zu auf "
    "el los las de y por con para su es al se una como"
).split()


@dataclass(frozen=True)
class Rule:
    """Votes good up to `good`, bad beyond `bad` (each a share), abstains between and for null, which a share of nothing is."""

    name: str
    share: str
    good: float
    bad: float

    def vote(self) -> Column:
        sign = 1 if self.good <= self.bad else -1
        value = F.expr(self.share) * sign
        good, bad = value <= sign * self.good, value > sign * self.bad
        return F.when(good, 1).when(bad, -1).otherwise(0).cast("int")


RULES = (
    Rule("length", "n_words", 100, 50),
    Rule("word_length", "try_divide(word_chars, n_words)", 10, 14),
    Rule("symbols", "try_divide(n_symbols, n_words)", 0.02, 0.1),
    Rule("duplicate_lines", "try_divide(n_dup_lines, n_lines)", 0.1, 0.3),
    Rule("repeated_words", "try_divide(n_repeat_words, n_words)", 0.1, 0.3),
    Rule("letters", "try_divide(n_letters, word_chars)", 0.85, 0.7),
    Rule("capitals", "try_divide(n_capitals, n_letters)", 0.15, 0.4),
    Rule("common_words", "try_divide(n_common, n_words)", 0.1, 0.04),
)
VOTES = (-1, 0, 1)
#: Where expectation-maximisation starts, and what its estimates are drawn to: vote shares -1, 0, 1.
START_GOOD, START_BAD, START_PRIOR = (0.02, 0.08, 0.9), (0.4, 0.2, 0.4), 0.9
ROUNDS, PRIOR_SHARE, THRESHOLD, DIGITS = 12, 0.02, 0.5, 9


def measures(text: Column) -> list[tuple[str, Column]]:
    """Columns to add one after the other; the later ones use the earlier ones."""
    windows = F.size("_words") - 2
    triple = F.transform(
        F.sequence(F.lit(0), windows - 1),
        lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    placed = F.transform("_triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    twice = F.expr(
        "transform(filter(sequence(0, size(_sorted) - 1), k -> "
        "_sorted[k].h = get(_sorted, k - 1).h or _sorted[k].h = get(_sorted, k + 1).h), k -> _sorted[k].i)"
    )
    covered = F.expr(
        "aggregate(array_sort(_twice), struct(-3 as last, 0L as n), "
        "(a, p) -> struct(p as last, a.n + least(3, p - a.last) as n), a -> a.n)"
    )
    none = F.array().cast("array<bigint>")
    return [
        ("_text", F.coalesce(text, F.lit(""))),
        ("_words", tx.words(F.col("_text"))),
        ("_lines", F.filter(F.split("_text", "\n"), lambda x: F.translate(x, " \t\n\x0b\f\r", "") != "")),
        ("n_words", F.size("_words").cast("long")),
        ("word_chars", F.length(F.translate("_text", " \t\n\x0b\f\r", "")).cast("long")),
        ("n_symbols", (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long")),
        ("n_lines", F.size("_lines").cast("long")),
        ("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")),
        ("n_letters", F.length(F.regexp_replace("_text", r"\P{L}+", "")).cast("long")),
        ("n_capitals", F.length(F.regexp_replace("_text", r"\P{Lu}+", "")).cast("long")),
        ("n_common", F.size(F.filter("_words", lambda w: F.lower(w).isin(COMMON_WORDS))).cast("long")),
        ("_triples", F.when(windows > 0, triple).otherwise(none)),
        ("_repeats", F.size("_triples") > F.size(F.array_distinct("_triples"))),
        ("_sorted", F.when(F.col("_repeats"), F.sort_array(placed))),
        ("_twice", F.when(F.col("_repeats"), twice)),
        ("n_repeat_words", F.coalesce(F.when(F.col("_repeats"), covered), F.lit(0)).cast("long")),
    ]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_letters", "n_capitals", "n_common", "n_repeat_words")


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs under their own names, with the measures and one vote per rule in struct `_q`."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), F.col("text").alias("_input"))
    for name, column in measures(F.col("_input")):
        df = df.withColumn(name, column)
    df = df.select("_row", *MEASURES)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    votes = [F.coalesce(rule.vote(), F.lit(0)).alias(rule.name) for rule in RULES]
    return df.select("_row", F.struct(*MEASURES, failed.alias("base_failed"), F.array(*votes).alias("votes")).alias("_q"))


def estimate(patterns: DataFrame) -> tuple[float, list[list[float]]]:
    """Log odds to start from, and each rule's log odds for the votes -1, 0, 1, from (votes, n) rows.

    One small aggregate a round; the driver sees a handful of sums, never rows.
    """
    total = patterns.agg(F.sum("n")).first()[0] or 0
    good = [list(START_GOOD) for _ in RULES]
    bad = [list(START_BAD) for _ in RULES]
    prior, pull = START_PRIOR, PRIOR_SHARE * total + 1
    for _ in range(ROUNDS if total else 0):
        odds = log_odds(prior, good, bad)
        is_good = 1 / (1 + F.exp(-score(F.col("votes"), *odds)))
        df = patterns.select("votes", (F.col("n") * is_good).alias("g"), (F.col("n") * (1 - is_good)).alias("b"))
        cells = [
            F.sum(F.when(F.get("votes", F.lit(j)) == v, F.col(side)).otherwise(0.0)).alias(f"{side}{j}_{v + 1}")
            for side in "gb" for j in range(len(RULES)) for v in VOTES
        ]
        sums = df.agg(F.sum("g").alias("g"), F.sum("b").alias("b"), *cells).first()
        prior = round((sums["g"] + pull * START_PRIOR) / (total + pull), DIGITS)
        for side, table, start in (("g", good, START_GOOD), ("b", bad, START_BAD)):
            for j in range(len(RULES)):
                table[j] = [
                    round((sums[f"{side}{j}_{k}"] + pull * start[k]) / (sums[side] + pull), DIGITS) for k in range(3)
                ]
    return log_odds(prior, good, bad)


def log_odds(prior: float, good: list[list[float]], bad: list[list[float]]) -> tuple[float, list[list[float]]]:
    """For good rather than bad. A bad vote never speaks for a document, nor a good vote against it."""
    table = [[math.log(g) - math.log(b) for g, b in zip(*row, strict=True)] for row in zip(good, bad, strict=True)]
    return math.log(prior) - math.log(1 - prior), [[min(x, 0.0), y, max(z, 0.0)] for x, y, z in table]


def score(votes: Column, start: float, table: list[list[float]]) -> Column:
    total = F.lit(start)
    for j, row in enumerate(table):
        total = total + F.get(F.array(*map(F.lit, row)), F.get(votes, F.lit(j)) + 1)
    return total


def judged(docs: DataFrame, keep: list[str], once: bool = True) -> DataFrame:
    """The columns `keep` with the base measures, `base_failed`, `quality` (posterior) and `kept`.

    once: store the measures between the two passes; else measure twice, which spares storing wide columns.
    """
    rows = written(measured(docs, keep)) if once else measured(docs, keep).withColumn("_serial", F.monotonically_increasing_id())
    votes = measured(docs, []) if not once else rows
    patterns = written(votes.groupBy(F.col("_q.votes").alias("votes")).agg(F.count("*").alias("n")))
    start, table = estimate(patterns)
    quality = 1 / (1 + F.exp(-score(F.col("_q.votes"), start, table)))
    kept = ~F.col("_q.base_failed") & (quality >= THRESHOLD)
    return rows.withColumns({"quality": quality, "kept": kept})


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id with the base measures and the verdict."""
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged(docs, ["doc_id"]).select("_row.doc_id", *[f"_q.{c}" for c in base], "kept")


def good_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    # The filter names the serial number so that it stays above the measures: pushed below, it would repeat them for every vote.
    return judged(docs, docs.columns, once=False).filter("kept and _serial >= 0").select("_row.*")
