"""Removal of long repeated passages by a compacted De Bruijn graph of words.

The edges of the graph are the windows of `window` words of the texts. Its nonbranching paths are found in two steps. In a
task, neighbouring windows of a text that have the same minimizer (the leftmost `gram` of words with the least hash) are one
edge from the start. Windows of equal words have equal minimizers, so where all such edges of a gram are equal, each stands
for all its windows; where they differ (at the ends of repeated passages), joins take them apart into single windows. Grams
that occur once are left out by a join before anything else. Then edges that follow each other in the texts are joined: two
become one path if every occurrence of each lies beside one of the other, so that nothing branches there, ends of texts
included. A path has the coordinates of its first occurrence. They verify it: its edges have to follow each other there, word
by word, and its spans are where its head occurs elsewhere.

So every word is removed that is covered by a window which also starts earlier: in a document with a smaller id, or before
in the same. Windows are compared by fingerprints of 128 bits and do not cross documents. Null texts have no words; texts
shorter than a window lose nothing; a text of any length is taken whole. Rows without an id come first in order. Rows that
repeat id and text are one document; with equal ids and different texts the smaller text hash comes first. An empty table
gives an empty result. Only doc_id and text are read. Frequent passages are counted in the tasks before they meet, and the
joins on them have the large side on the left, where Spark can split them. What is gathered or ordered in one task belongs
to one document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.places import no_of, numbered, start_of
from shelfline.llm.scratch import remove, written
from shelfline.llm.suffixes import anchors
from shelfline.llm.wordprints import SPACES, flags, hashes, runs, slices, spans

WINDOW, GRAM = 20, 6
PRINT = ["fp1", "fp2"]
#: Bits of a place for the word in its text: a text has fewer than 2^27 words, and there are fewer than 2^36 documents.
BITS = 27
_BETWEEN = flags(SPACES)


def _words(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each word, its text's number, and the number of each text's first word."""
    starts, ends, of = spans(data, edges, _BETWEEN)
    return hashes(data, starts, ends, 1), hashes(data, starts, ends, 3), of, np.searchsorted(of, np.arange(len(edges) - 1))


def edges_of(data: np.ndarray, edges: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each run of windows with one minimizer: text number, gram, two fingerprints, first window, how many windows."""
    one, two, of, base = _words(data, edges)
    if len(one) < window:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    grams = runs(one, gram)
    anchor = anchors(grams, window - gram + 1)
    whole = of[: len(anchor)] == of[window - 1 :]
    fresh = np.append(True, (anchor[1:] != anchor[:-1]) | ~whole[:-1]) & whole
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(anchor)) - 1
    # The last window of a run is in front of the next run or of the windows that cross into another text.
    crossing = np.flatnonzero(~whole)
    stop = np.append(crossing, len(anchor))[np.searchsorted(crossing, first)]
    last = np.minimum(last, stop - 1)
    prints = []
    for words in (one, two):
        w = runs(words, window)
        prints.append(runs(np.column_stack([w[first], w[last], (last - first).astype(np.uint64)]).reshape(-1), 3)[::3].view(np.int64))
    text = of[first]
    return text, grams[anchor[first]].view(np.int64), *prints, first - base[text], last - first + 1


def _places(no: np.ndarray, start: np.ndarray) -> pa.Array:
    if len(start) and int(start.max()) >> BITS:
        raise ValueError(f"a text has more than {1 << BITS} words")
    return pa.array((no << BITS) + start, pa.int64())


def super_windows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(gram, fp1, fp2, place, n) of all runs of windows with one minimizer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no = batch["no"].to_numpy()
            for low, _, data, edges in slices(batch):
                text, key, fp1, fp2, start, n = edges_of(data, edges, window, gram)
                if len(text):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp1), pa.array(fp2), _places(no[low + text], start), pa.array(n, pa.int32())], ["gram", *PRINT, "place", "n"])

    return rows.select("no", "text").mapInArrow(run, "gram bigint, fp1 bigint, fp2 bigint, place bigint, n int")


def _single_windows(rows: DataFrame, parts: DataFrame, window: int) -> DataFrame:
    """(fp1, fp2, place) of each window of the given runs."""
    lists = parts.groupBy(no_of("place", BITS).alias("of")).agg(F.collect_list(F.struct(start_of("place", BITS).alias("start"), "n")).alias("p"))
    lists = lists.select("of", F.col("p.start").alias("starts"), F.col("p.n").alias("ns"))
    both = rows.join(lists, F.col("no") == F.col("of")).select("no", "text", "starts", "ns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, edges in slices(batch):
                one, two, _, base = _words(data, edges)
                own = batch.slice(low, high - low)
                counts = np.array([len(x) for x in own["starts"]])
                starts, ns = (own[c].flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("starts", "ns"))
                text = np.repeat(np.repeat(np.arange(len(counts)), counts), ns)
                start = np.repeat(starts, ns) + np.arange(ns.sum()) - np.repeat(np.cumsum(ns) - ns, ns)
                at = start + base[text]
                prints = [pa.array(runs(words, window)[at].view(np.int64)) for words in (one, two)]
                yield pa.RecordBatch.from_arrays([*prints, _places(own["no"].to_numpy()[text], start)], [*PRINT, "place"])

    return both.mapInArrow(run, "fp1 bigint, fp2 bigint, place bigint")


def _counted(found: DataFrame, *more) -> DataFrame:
    """One row per fingerprint: its first place and how often it occurs."""
    return found.groupBy(*PRINT).agg(F.min("place").alias("first"), F.count("*").alias("times"), *more)


def repeated_edges(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(place, n, first, times): all occurrences of edges that occur more than once. `first` is the first place and names the edge."""
    shared = written(super_windows(rows, window, gram).groupBy("gram").agg(F.count("*").alias("times")).filter("times > 1").select("gram"))
    found = written(super_windows(rows, window, gram).join(shared, "gram", "left_semi"))
    remove(shared)
    contents = written(_counted(found, F.any_value("gram").alias("gram")))
    # Grams whose runs of windows are not all equal.
    unlike = written(contents.groupBy("gram").agg(F.count("*").alias("contents")).filter("contents > 1").select("gram"))
    names = ["place", "n", "first", "times"]
    alike = contents.join(unlike, "gram", "left_anti").filter("times > 1").select(*PRINT, "first", "times")
    whole = written(found.join(alike, PRINT).select(*names))
    single = written(_single_windows(rows, found.join(unlike, "gram", "left_semi"), window))
    for step in (found, contents, unlike):
        remove(step)
    more = _counted(single).filter("times > 1")
    out = written(whole.unionByName(single.join(more, PRINT).withColumn("n", F.lit(1)).select(*names)))
    remove(whole)
    remove(single)
    return out


def paths(edges: DataFrame) -> DataFrame:
    """(head, windows): the nonbranching paths of the edges, each named by the place where its head occurs first."""
    after = edges.select(F.col("place").alias("end"), F.col("first").alias("next"), F.col("times").alias("next_times"))
    beside = edges.withColumn("end", F.col("place") + F.col("n")).join(after, "end")
    pairs = beside.groupBy("first", "next").agg(F.count("*").alias("together"), F.any_value("n").alias("n"), F.any_value("times").alias("times"), F.any_value("next_times").alias("next_times"))
    # All occurrences of both are side by side, and so are the first ones.
    unbranched = (F.col("together") == F.col("times")) & (F.col("together") == F.col("next_times"))
    verified = F.col("first") + F.col("n") == F.col("next")
    continued = pairs.filter(unbranched & verified).select(F.col("next").alias("place"), F.lit(True).alias("continued"))
    own = edges.filter("place = first").select("place", "n").distinct().join(continued, "place", "left")
    number = F.sum(F.col("continued").isNull().cast("int")).over(Window.partitionBy("no").orderBy("place"))
    joined = own.withColumn("no", no_of("place", BITS)).select("no", "place", "n", number.alias("path"))
    return joined.groupBy("no", "path").agg(F.min("place").alias("head"), F.sum("n").cast("int").alias("windows")).select("head", "windows")


def repeats(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(no, start, stop): runs of words of the numbered rows that are covered by windows that start earlier."""
    if not 0 < gram <= window or window < 2:
        raise ValueError("a window has two words or more, and a gram not more than a window")
    edges = repeated_edges(rows, window, gram)
    heads = written(paths(edges))
    elsewhere = edges.filter("place <> first").join(heads, F.col("first") == F.col("head"))
    start = start_of("place", BITS)
    out = written(elsewhere.select(no_of("place", BITS).alias("no"), start.cast("int").alias("start"), (start + F.col("windows") + window - 1).cast("int").alias("stop")))
    remove(edges)
    remove(heads)
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high, data, edges in slices(batch):
            own, out = batch.slice(low, high - low), []
            texts = [data[a:b].tobytes().split() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            for words, starts, stops in zip(texts, own["starts"], own["stops"], strict=True):
                n = len(words)
                if starts.is_valid:
                    change = np.zeros(n + 1, np.int64)
                    np.add.at(change, starts.values.to_numpy(), 1)
                    np.add.at(change, stops.values.to_numpy(), -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                kept = b" ".join(words)
                out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode(errors="replace")))
            columns = [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([own["doc_id"], *columns], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def removed(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and kept, the words that stay joined by spaces."""
    rows = numbered(docs, BITS)
    lists = repeats(rows, window, gram).groupBy(F.col("no").alias("of")).agg(F.collect_list(F.struct("start", "stop")).alias("r"))
    lists = lists.select("of", F.col("r.start").alias("starts"), F.col("r.stop").alias("stops"))
    both = rows.join(lists, F.col("no") == F.col("of"), "left").select("doc_id", "text", "starts", "stops")
    return both.mapInArrow(_cut, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def oracle() -> str:
    space = r"[\x20\x09-\x0D]+"
    return f"""
    with words as materialized (
        select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{space}'), lambda w: w <> '') as w from documents
    ), windows as (
        select doc_id, s, array_to_string(w[s + 1 : s + {WINDOW}], ' ') as v
        from (select doc_id, w, unnest(range(0, len(w) - {WINDOW} + 1)) as s from words)
    ), later as (
        select doc_id, s from (select doc_id, s, row_number() over (partition by v order by doc_id, s) as k from windows) where k > 1
    ), gone as (
        select distinct doc_id, s + unnest(range(0, {WINDOW})) as p from later
    ), kept as (
        select w.doc_id, w.p, w.x from (select doc_id, unnest(range(0, len(w))) as p, unnest(w) as x from words) w anti join gone using (doc_id, p)
    ), joined as (
        select doc_id, count(*) as n, string_agg(x, ' ' order by p) as t from kept group by doc_id
    )
    select w.doc_id, cast(len(w.w) as bigint) as n_words, cast(len(w.w) - coalesce(j.n, 0) as bigint) as n_removed, sha256(coalesce(j.t, '')) as kept_sha256
    from words w left join joined j using (doc_id)
    """
