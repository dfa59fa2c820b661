"""Near-duplicate documents by MinHash, odd sketches and exact verification.

A document's set is its distinct word shingles as 64-bit hashes. Documents with equal sets form a
class that goes on as its smallest id. Bands of MinHash samples bring classes that are alike into
buckets; there each is compared with the bucket's smallest id, and then those that are not of the
component most of the bucket belongs to with all that are of another. Odd sketches (the samples folded into a parity bitmap, whose
XOR has a population count that tells the similarity) drop pairs that are far from the threshold;
the others are decided on the full sets.

A pair at the threshold shares no band once in four million times (0.85: 32 bands of 6). Sketches hold
more samples than the bands: at 512, a threshold lies over five deviations above the similarity at
which pairs are dropped, so they lose about one in ten million, yet keep few of the many pairs that
members of a large group form below it.

Null and empty texts have empty sets, link with nothing and are kept. Rows that repeat an id are
one document: one component, each row with its own set size. Rows without an id link with nothing:
their component is null and they are kept. An empty table gives an empty result. Other columns are
not read, so they may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm import blocks
from shelfline.llm import text as tx
from shelfline.llm.graph import components
from shelfline.llm.scratch import written


@dataclass(frozen=True)
class Params:
    """percent: the least similarity, in hundredths. samples: bands * rows at least; all go into the sketch. sketch_bits: a multiple of 64."""

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    samples: int = 512
    sketch_bits: int = 2048
    sketch_slack: float = 0.1
    seed: int = 7

    @property
    def most_bits(self) -> int:
        """Differing sketch bits expected at `sketch_slack` below the threshold; more drop a pair."""
        differing = 2 * self.samples * (1 - self.percent / 100 + self.sketch_slack)
        return int(self.sketch_bits / 2 * (1 - (1 - 2 / self.sketch_bits) ** differing))


#: As many blocks a side meet in one group while sketches are compared: these are small, so members travel less often.
MEETING = 8
#: More blocks than a chunk of members has: chunks are dealt by hashes, so their sizes vary.
_PARTS = 1024
#: For the query's contract: three words, 0.85.
CONTRACT = Params(shingle=3, percent=85, bands=32, rows=6)


def shingle_sets(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id and its sorted distinct shingle hashes."""
    rows = docs.select("doc_id", tx.words(tx.ascii_lower(F.col("text"))).alias("words"))
    hashes = tx.shingle_hashes(F.col("words"), p.shingle)
    return rows.select("doc_id", F.sort_array(F.array_distinct(hashes)).alias("shingles"))


def _samples(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function a * x + b over the set, in blocks that fit the cache."""
    x = (hashes.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), np.iinfo(np.uint32).max, dtype=np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(least, (x[i : i + 256, None] * a + b).min(axis=0), out=least)
    return least


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _signatures(p: Params):
    """A Pandas UDF from shingle hashes to band keys and the odd sketch."""

    @F.pandas_udf("bands array<bigint>, sketch array<bigint>")
    def signature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rng = np.random.default_rng(p.seed)
        a = rng.integers(0, 2**32, p.samples, dtype=np.uint32) | np.uint32(1)
        b = rng.integers(0, 2**32, p.samples, dtype=np.uint32)
        place = np.arange(p.samples, dtype=np.uint64) << np.uint64(32)
        for sets in batches:
            out_bands, out_sketch = [], []
            for hashes in sets:
                if len(hashes) == 0:
                    out_bands.append(np.empty(0, np.int64))
                    out_sketch.append(np.zeros(p.sketch_bits // 64, np.int64))
                    continue
                tagged = _mixed(_samples(np.asarray(hashes, np.int64), a, b).astype(np.uint64) | place)
                bands = np.zeros(p.bands, np.uint64)
                for column in tagged[: p.bands * p.rows].reshape(p.bands, p.rows).T:
                    bands = _mixed(bands * np.uint64(0xD6E8FEB86659FD93) + column)
                odd = np.bincount((tagged % np.uint64(p.sketch_bits)).astype(np.int64), minlength=p.sketch_bits) & 1
                out_bands.append(bands.view(np.int64))
                out_sketch.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pd.DataFrame({"bands": out_bands, "sketch": out_sketch})

    return signature


def signed(docs: DataFrame, p: Params) -> DataFrame:
    """doc_id, set size, the set's 128-bit fingerprint, band keys and sketch."""
    return shingle_sets(docs, p).select(
        "doc_id",
        F.size("shingles").cast("long").alias("n"),
        F.struct(F.xxhash64("shingles").alias("x"), F.xxhash64(F.lit(p.seed), "shingles").alias("y")).alias("print"),
        _signatures(p)("shingles").alias("sig"),
    ).select("doc_id", "n", "print", "sig.bands", "sig.sketch")


def _alike(p: Params) -> Column:
    """Whether sizes and sketches of a pair allow the similarity."""
    bits = sum(
        F.bit_count(F.get("sketch_a", F.lit(i)).bitwiseXOR(F.get("sketch_b", F.lit(i)))) for i in range(p.sketch_bits // 64)
    )
    sizes = 100 * F.least("n_a", "n_b") >= p.percent * F.greatest("n_a", "n_b")
    return sizes & (bits <= p.most_bits)


def _side(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(F.col("doc_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))


def _linked(pairs: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Of the pairs (a, b), those whose full sets are similar enough."""
    pairs = written(pairs)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = written(shingle_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), p))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return written(
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
        .filter((union > 0) & (100 * both >= p.percent * union))
        .select("a", "b")
    )


def _linked_in_blocks(members: DataFrame, classes: DataFrame, docs: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) that join members (band, doc_id, label, apart) of a band with those apart that are similar enough and of another label.

    Each chunk of those apart meets each of all members in one group: sketches tell which members have a
    candidate there, and only these bring their full sets, in blocks. A pair that shares several bands
    counts in the first of them alone.
    """
    keys, side = ["band", "i", "j"], F.col("side")
    wide = MEETING * blocks.SIZE
    count = members.groupBy("band").agg(
        blocks.chunks(F.count_if("apart"), wide).alias("lefts"), blocks.chunks(F.count("*"), wide).alias("rights"))
    both = members.filter("apart").withColumn("side", F.lit(0)).unionByName(members.withColumn("side", F.lit(1)))
    both = both.join(count, "band").withColumn("own", blocks.chunk("doc_id", F.when(side == 0, F.col("lefts")).otherwise(F.col("rights"))))
    # Sketches are fetched once a member, before it is copied for the chunks that it meets: copies are shuffled once, not twice.
    both = both.join(classes.select("doc_id", "n", "sketch", "bands"), "doc_id")
    both = both.withColumn("with", F.explode(F.sequence(F.lit(0), F.when(side == 0, F.col("rights")).otherwise(F.col("lefts")) - 1)))
    placed = both.select(
        "band", F.when(side == 0, F.col("own")).otherwise(F.col("with")).alias("i"),
        F.when(side == 0, F.col("with")).otherwise(F.col("own")).alias("j"), "side", "doc_id", "label", "apart", "n", "sketch", "bands")
    most, percent, size = p.most_bits, p.percent, blocks.SIZE

    def candidates(group: pd.DataFrame) -> pd.DataFrame:
        band, i, j = (int(group[k].iloc[0]) for k in keys)
        of, apart, label, n = (group[c].to_numpy() for c in ("doc_id", "apart", "label", "n"))
        # Unsigned: of a negative number, the bits of its absolute value would be counted.
        sketch, bands = np.stack(group["sketch"].to_list()).view(np.uint64), np.stack(group["bands"].to_list())
        found, (left, right) = [], (np.flatnonzero(group["side"].to_numpy() == s) for s in (0, 1))
        for low in range(0, len(left), size):
            for start in range(0, len(right), size):
                x, y = left[low : low + size, None], right[start : start + size]
                near = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
                # Two that are apart meet twice.
                near &= (label[x] != label[y]) & (~apart[y] | (of[x] < of[y]))
                x = x[near.any(axis=1), 0]
                near = near[near.any(axis=1)]
                near &= np.bitwise_count(sketch[x, None] ^ sketch[y]).sum(axis=2, dtype=np.int64) <= most
                one, two = (at[k] for at, k in zip((x, y), np.nonzero(near), strict=True))
                first = (bands[one] == bands[two]).argmax(axis=1)
                here = bands[one, first] == band
                for s, of_side in enumerate((one, two)):
                    ids = of[np.unique(of_side[here])]
                    found.append(pd.DataFrame({"band": band, "i": i * _PARTS + low // size, "j": j * _PARTS + start // size, "side": s, "doc_id": ids}))
        return pd.concat(found) if found else pd.DataFrame({c: [] for c in [*keys, "side", "doc_id"]})

    def verified(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["side"] == 0], group[group["side"] == 1]
        n, m = left["shingles"].map(len).to_numpy()[:, None], right["shingles"].map(len).to_numpy()
        shared = blocks.intersections(left["shingles"].to_list(), right["shingles"].to_list())
        linked = np.zeros((len(group), len(group)), bool)
        linked[: len(left), len(left) :] = 100 * shared >= percent * (n + m - shared)
        at, to = blocks.forest(linked | linked.T)
        ids = np.concatenate([left["doc_id"].to_numpy(), right["doc_id"].to_numpy()])
        return pd.DataFrame({"a": np.minimum(ids[at], ids[to]), "b": np.maximum(ids[at], ids[to])})

    schema = "band bigint, i int, j int, side int, doc_id bigint"
    some = written(blocks.in_groups(placed, keys, candidates, schema))
    sets = written(shingle_sets(docs.select("doc_id", "text").join(some.select("doc_id").distinct(), "doc_id", "left_semi"), p))
    return written(blocks.in_groups(some.join(sets, "doc_id"), keys, verified, "a bigint, b bigint").distinct())


def groups(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id (smallest id reachable by links), kept."""
    rows = written(signed(docs, p))
    named = rows.filter("n > 0 and doc_id is not null")
    classes = written(
        named.groupBy("print").agg(
            F.min("doc_id").alias("doc_id"),
            F.min_by(F.struct("n", "bands", "sketch"), "doc_id").alias("of"),
        ).select("print", "doc_id", "of.*")
    )
    entries = classes.select("doc_id", F.explode("bands").alias("band"))
    buckets = entries.groupBy("band").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("members")).filter("members > 1")
    placed = written(entries.join(buckets.drop("members"), "band"))

    stars = placed.filter("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = stars.join(_side(classes, "a"), "a").join(_side(classes, "b"), "b").filter(_alike(p)).select("a", "b")
    links = _linked(stars, docs, p)

    # Buckets with members of several components: those outside the bucket's commonest one may still link with all others.
    # The pivot has been compared with each.
    of = components(links).select(F.col("id").alias("doc_id"), "component")
    labelled = written(placed.filter("doc_id <> pivot").join(of, "doc_id", "left").select("band", "doc_id", F.coalesce("component", "doc_id").alias("label")))
    mixed = labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("band")
    crowd = labelled.join(mixed, "band", "left_semi")
    sizes = crowd.groupBy("band", "label").agg(F.count("*").alias("size"))
    home = sizes.groupBy("band").agg(F.max_by("label", F.struct("size", "label")).alias("home"))
    members = written(crowd.join(home, "band").select("band", "doc_id", "label", (F.col("label") != F.col("home")).alias("apart")))
    more = _linked_in_blocks(members, classes, docs, p)

    shared = named.groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1")
    leaders = classes.select("print", F.col("doc_id").alias("leader"))
    same_id = named.join(shared, "doc_id", "left_semi").join(leaders, "print").select(F.col("doc_id").alias("a"), F.col("leader").alias("b"))
    final = components(links.unionByName(more).unionByName(same_id))

    led = rows.select("doc_id", "n", "print").join(leaders, "print", "left")
    leader = F.when(F.col("n") > 0, F.coalesce("leader", "doc_id")).otherwise(F.col("doc_id"))
    led = led.select("doc_id", F.col("n").alias("n_shingles"), leader.alias("id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id"))
    return led.join(final, "id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row of each group, with all its columns: that of the smallest id, those without an id last.

    Every row counts for itself, by a number of its own: texts link, whatever ids repeat or lack.
    Rows with empty sets stay.
    """
    rows = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_serial")))
    found = groups(rows.select(F.col("_serial").alias("doc_id"), F.col("_row.text").alias("text")), p)
    found = found.select(F.col("doc_id").alias("_serial"), "component_id")
    members = written(rows.select("_serial", F.col("_row.doc_id").alias("doc_id")).join(found, "_serial"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_serial")
    first = members.groupBy("component_id").agg(F.min(place).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    gone = members.join(first, "component_id").filter("_serial <> first._serial").select("_serial")
    return rows.join(gone, "_serial", "left_anti").select("_row.*")
