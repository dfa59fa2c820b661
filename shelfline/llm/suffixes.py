"""Removal of passages that repeat, by a family of suffix arrays of geometric sizes.

A suffix array here is sparse and sorted by fingerprints, as only equality counts. Of each string of
`length` bytes the leftmost gram with the least hash is its anchor, so equal strings have equal
anchors at equal places, and one suffix in about 40 is indexed: the block of all strings in a row
with one anchor. Documents come in batches in the order of their ids. A batch gets its array, which
meets each level for blocks that are known; the new blocks form a level, and levels of equal size
merge at once. All arrays are bucketed and sorted by the same fingerprints, so that a batch meets
the levels, and levels merge, bucket by bucket without a shuffle. What a batch finds is final: only
earlier documents are in the levels. A block that is not the first of its content is covered as a
whole. Blocks that share an anchor's gram but are not equal may share some strings: these blocks
alone are taken apart into strings, each decided by its first occurrence.

So every byte is removed that a string of `length` bytes covers which also starts earlier: in a
document with a smaller id, or before in the same. Fingerprints have 128 bits: 64 of the gram and 64
of the block, or two of 64 of a string. Matches never cross documents. Null texts are empty; texts
shorter than `length` lose nothing; a text of any length is taken whole. Rows without an id come
first in order. Rows that repeat id and text are one document; with equal ids and different texts
the smaller text hash comes first. An empty table gives an empty result. Only doc_id and text are
read. Every group that is collected is a part of one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.places import no_of, numbered, start_of
from shelfline.llm.scratch import bucketed, remove, written
from shelfline.llm.wordprints import slices

LENGTH, GRAM, BATCHES = 100, 32, 4
#: Bytes of text behind a bucket of a family: its arrays have about half as many.
BUCKET = 64 << 20
PRINT, ENTRY = ["fp1", "fp2"], ["gram", "fp"]
#: Bytes of texts that are hashed together: what that takes stays in the cache.
SLICE = 1 << 18
#: Bits of a place for the byte in its text: a text has less than 2^30 bytes, and there are fewer than 2^33 documents.
BITS = 30


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def string_hashes(data: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A 64-bit hash of each string of `length` bytes, from those of half and quarter lengths."""
    rng = np.random.default_rng(seed)
    power, factor = rng.integers(0, 2**63, 256, dtype=np.uint64)[data], rng.integers(0, 2**62, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total, done, span = None, 0, 1
    # From the binary digits of the length, the smallest part in front.
    while True:
        if length & span:
            if total is None:
                total = power
            else:
                n = len(total) - span
                total = _mixed(total[: max(n, 0)] * factor + power[done : done + max(n, 0)])
            done += span
        span *= 2
        if span > length:
            return total[: max(len(data) - length + 1, 0)]
        half = span // 2
        n = max(len(power) - half, 0)
        power = _mixed(power[:n] * factor + power[half : half + n])


def anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """The leftmost place of the least value (by its upper 32 bits) in each window of `width` values."""
    least, span = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64), 1
    while span * 2 <= width:
        least, span = np.minimum(least[: len(least) - span], least[span:]), span * 2
    rest = width - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _whole(grams: np.ndarray, at: np.ndarray, length: int, gram: int) -> np.ndarray:
    """A 64-bit hash of the string of `length` bytes at each place, from those of the grams that cover it."""
    out = grams[at]
    for offset in [*range(gram, length - gram, gram), length - gram]:
        out = _mixed(out * np.uint64(0xC2B2AE3D27D4EB4F) + grams[at + offset])
    return out


def blocks(data: np.ndarray, edges: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each block of the texts between the edges: its text's number, its gram's hash, its fingerprint, the start of its first string, and how many strings it has."""
    if len(data) < length:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    grams = string_hashes(data, gram, 1)
    anchor = anchors(grams, length - gram + 1)
    # Strings that cross into another text are none.
    whole = np.ones(len(anchor) + 1, bool)
    whole[-1] = False
    for edge in edges[1:-1]:
        whole[max(edge - length + 1, 0) : edge] = False
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | ~whole[:-2]) & whole[:-1]
    first = np.flatnonzero(fresh)
    ends = np.flatnonzero(~whole)
    last = np.minimum(np.append(first[1:], len(anchor)), ends[np.searchsorted(ends, first)]) - 1
    front, back = (_whole(grams, at, length, gram) for at in (first, last))
    fp = _mixed(_mixed(front + (last - first).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93) + back)
    text = np.searchsorted(edges, first, "right") - 1
    return text, grams[anchor[first]].view(np.int64), fp.view(np.int64), first - edges[text], last - first + 1


def _places(no: np.ndarray, start: np.ndarray) -> pa.Array:
    if len(start) and int(start.max()) >> BITS:
        raise ValueError(f"a text has more than {1 << BITS} bytes")
    return pa.array((no << BITS) + start, pa.int64())


def entries(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, fp, place, n) of all blocks of the numbered rows."""
    if length > 2 * gram + 100 or gram > length:
        raise ValueError("a block's first and last string must cover it")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no = batch["no"].to_numpy()
            for low, _, data, edges in slices(batch, size=SLICE):
                text, key, fp, start, n = blocks(data, edges, length, gram)
                if len(text):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), _places(no[low + text], start), pa.array(n, pa.int32())], [*ENTRY, "place", "n"])

    return rows.select("no", "text").mapInArrow(run, "gram bigint, fp bigint, place bigint, n int")


def _firsts(found: DataFrame, by: list[str], *more: Column) -> DataFrame:
    """One row per content: its first occurrence and their number. Combined before the shuffle, so hot passages don't gather."""
    return found.groupBy(*by).agg(F.min("place").alias("first"), F.count("*").alias("times"), *more)


@dataclass
class Family:
    """levels: (batches, suffix array) of falling sizes; all contents are distinct over all levels. covered: (place, bytes)."""

    length: int = LENGTH
    gram: int = GRAM
    buckets: int = 8
    levels: list[tuple[int, DataFrame]] = field(default_factory=list)
    covered: list[DataFrame] = field(default_factory=list)
    merges: int = 0

    def all(self) -> DataFrame:
        out = self.levels[0][1]
        for _, level in self.levels[1:]:
            out = out.unionByName(level)
        return out

    def _stored(self, array: DataFrame) -> DataFrame:
        return bucketed(array, self.buckets, ENTRY)

    def _met(self, array: DataFrame) -> DataFrame:
        """The blocks of a batch's array that a level has."""
        out = None
        for _, level in self.levels:
            some = array.join(level.select(*ENTRY), ENTRY, "left_semi")
            out = some if out is None else out.unionByName(some)
        return out

    def add(self, rows: DataFrame) -> None:
        """Index a batch that comes after all that are indexed, and keep what it repeats."""
        own = entries(rows, self.length, self.gram)
        array = self._stored(_firsts(own, ENTRY, F.any_value("n").alias("n")))
        new, again, done = array, array.filter("times > 1").withColumn("known", F.lit(False)), []
        if self.levels:
            # Levels have no content in common, so a block is met by one of them at most.
            known = self._stored(self._met(array))
            new, done = array.join(known.select(*ENTRY), ENTRY, "left_anti"), [array, known]
            again = new.filter("times > 1").withColumn("known", F.lit(False)).unionByName(known.withColumn("known", F.lit(True)))
        later = own.join(again.select(*ENTRY, "first", "known"), ENTRY).filter("known or place <> first")
        self.covered.append(written(later.select("place", (F.col("n") - 1 + self.length).alias("bytes"))))
        # A merge that makes the next one due is not written by itself: all levels concerned go into the last one at once.
        batches = 1
        while self.levels and self.levels[-1][0] == batches:
            n, level = self.levels.pop()
            new, batches = new.unionByName(level), batches + n
            done.append(level)
            self.merges += 1
        self.levels.append((batches, self._stored(new) if done else new))
        for step in done:
            remove(step)


def _runs(starts: np.ndarray, ns: np.ndarray) -> np.ndarray:
    """All numbers of runs that start at `starts` and are `ns` long."""
    return np.repeat(starts - np.cumsum(ns) + ns, ns) + np.arange(ns.sum())


def _hashed(data: np.ndarray, starts: np.ndarray, ns: np.ndarray, length: int) -> list[np.ndarray]:
    """Two hashes of each of the `ns` strings from each start on. Only bytes of these are hashed, about `SLICE` at a time."""
    sizes, found, low = ns + length - 1, ([], []), 0
    filled = np.append(0, np.cumsum(sizes))
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(filled, filled[low] + SLICE, "right")) - 1)
        some = data[_runs(starts[low:high], sizes[low:high])]
        at = _runs(filled[low:high] - filled[low], ns[low:high])
        for out, seed in zip(found, (2, 3), strict=True):
            out.append(string_hashes(some, length, seed)[at])
        low = high
    return [np.concatenate(out) for out in found]


def _strings(rows: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """(fp1, fp2, place, later) of all strings of the given blocks.

    A string that has occurred before in a task's slice of texts is `later` than another for sure. Such rows have prints of
    their own, so that a hot string meets in one place with a row from each slice only.
    """
    lists = parts.groupBy(no_of("first", BITS).alias("of")).agg(F.collect_list(F.struct(start_of("first", BITS).alias("start"), "n")).alias("p"))
    lists = lists.select("of", F.col("p.start").alias("starts"), F.col("p.n").alias("ns"))
    both = rows.join(lists, F.col("no") == F.col("of")).select("no", "text", "starts", "ns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, edges in slices(batch):
                own = batch.slice(low, high - low)
                counts = np.array([len(x) for x in own["starts"]])
                starts, ns = (own[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("starts", "ns"))
                of = np.repeat(np.arange(len(counts)), counts)
                place = _places(np.repeat(own["no"].to_numpy()[of], ns), _runs(starts, ns)).to_numpy()
                one, two = _hashed(data, starts + edges[of], ns, length)
                order = np.argsort(one)
                one, two, place = one[order], two[order], place[order]
                # Strings that differ in the second hash only may lie between equal ones: these are left to be ranked.
                head = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
                later = place > np.minimum.reduceat(place, np.flatnonzero(head))[np.cumsum(head) - 1]
                one[later], two[later] = _mixed(place[later].astype(np.uint64)), place[later].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(place), pa.array(later)], [*PRINT, "place", "later"])

    return both.mapInArrow(run, "fp1 bigint, fp2 bigint, place bigint, later boolean")


def repeats(rows: DataFrame, family: Family) -> DataFrame:
    """(no, start, stop): byte ranges of the indexed rows that strings of earlier starts cover. Ends the family: its levels go."""
    known = family.all()
    shared = known.groupBy("gram").agg(F.count("*").alias("blocks")).filter("blocks > 1").select("gram")
    apart = written(known.join(shared, "gram", "left_semi").select("first", "n"))
    for _, level in family.levels:
        remove(level)
    # Rows that repeat id and text have equal places, and so equal ranks.
    nth = F.rank().over(Window.partitionBy(*PRINT).orderBy("place"))
    single = _strings(rows, apart, family.length).withColumn("nth", nth).filter("later or nth > 1")
    out = written(single.select("place", F.lit(family.length).alias("bytes")))
    for more in family.covered:
        out = out.unionByName(more)
    start = start_of("place", BITS)
    return out.select(no_of("place", BITS).alias("no"), start.cast("int").alias("start"), (start + F.col("bytes")).cast("int").alias("stop"))


def indexed(rows: DataFrame, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM) -> Family:
    """A family of all numbered rows, added in batches by their order."""
    shares = [k / batches for k in range(1, batches)]
    size, marks = rows.select(F.sum(F.octet_length("text")), F.percentile_approx("no", shares or [0.5], 1000)).first()
    family = Family(length, gram, max(8, -(-(size or 0) // BUCKET)))
    marks = sorted(set(marks or [])) if shares else []
    for k in range(len(marks) + 1):
        own = F.lit(True)
        if k:
            own &= F.col("no") > marks[k - 1]
        if k < len(marks):
            own &= F.col("no") <= marks[k]
        family.add(rows.filter(own))
    return family


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
    for batch in batches:
        for low, high, data, edges in slices(batch):
            own, out = batch.slice(low, high - low), []
            for a, b, starts, stops in zip(edges[:-1], edges[1:], own["starts"], own["stops"], strict=True):
                text = data[a:b]
                if not starts.is_valid:
                    kept = text.tobytes()
                    out.append((len(kept), 0, 0, hashlib.sha256(kept).hexdigest(), kept))
                    continue
                change = np.zeros(len(text) + 1, np.int32)
                np.add.at(change, starts.values.to_numpy(), 1)
                np.add.at(change, stops.values.to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = text[~gone].tobytes()
                spans = int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum())
                out.append((len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(x, kind) for x, (_, kind) in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([own["doc_id"], *columns], ["doc_id", *[n for n, _ in kinds]])


def removed(docs: DataFrame, batches: int = BATCHES, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept, the bytes that stay."""
    rows = numbered(docs, BITS)
    family = indexed(rows, batches, length, gram)
    ranges = written(repeats(rows, family).distinct())
    for step in family.covered:
        remove(step)
    lists = ranges.groupBy(F.col("no").alias("of")).agg(F.collect_list(F.struct("start", "stop")).alias("r"))
    lists = lists.select("of", F.col("r.start").alias("starts"), F.col("r.stop").alias("stops"))
    both = rows.join(lists, F.col("no") == F.col("of"), "left").select("doc_id", "text", "starts", "stops")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(_cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
