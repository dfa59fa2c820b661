"""Mining of phrases that occur often, by SON partitioning, and their score as collocations.

Shards are blocks of texts of one language, of bounded size, each within one task. First every shard is mined completely for
phrases of up to `longest` words, level by level, at a local support in proportion to its share of the language's bytes: a
phrase with `support` occurrences reaches it in one shard at least. What a shard doesn't report occurs there less often than
that, so the reports bound a phrase's occurrences from above, and their union is taken of phrases whose bound reaches
`support`. Then the shards are counted again, exactly and for these candidates: a bit filter of a fixed size says which
phrases may be candidates, all occurrences of what passes are counted, and phrases below `support` go.

The filter is what driver and tasks share, `FILTER_BITS` long at every size; more candidates than fit well make it pass more,
never less. A language is cut into about SHARDS shards at every size, so that the local support is the same, and into more where a shard
would outgrow BLOCK. With so many shards that less than SHARE occurrences each are asked for, the local support is 1 and shards
report in another form, so that what travels stays in proportion to the words: not the phrase and its numbers, but the first
PREFIX bits of its hash and its occurrences, sorted and compressed to three or four bytes; and the lengths come in two turns, so
that longer phrases are reported only where the pairs that make them up reached `support` in all shards together. Phrases that
share these bits are bounded together, which lets through more candidates, never less; the exact count is the same.

Words are runs without blanks, in pieces that end at punctuation or line ends; A-Z are lower-cased. Phrases don't cross
pieces. All is per language; null is `und`. Null texts are empty; a language without phrases has no rows; texts longer than
a block are a shard of their own. Rows that repeat are each counted. Ties in the score of cuts go to the first cut; in rank
to the more frequent, then to the phrase in byte order. Only text and lang are read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.scratch import remove, shuffles_freed, written
from shelfline.llm.text import ascii_lower
from shelfline.llm.wordprints import BYTES, flags, hashes, mixed, slices, spans

LONGEST, SUPPORT, TOP = 5, 100, 2000
#: A language has about SHARDS shards at any size, and more only where one would have over BLOCK bytes of text.
BLOCK, SHARDS = 24 << 20, 32
#: Parts that a shard's phrases of one length are sorted in.
PARTS = 8
#: Bits of the filter and places of a phrase in it.
FILTER_BITS, PLACES = 1 << 26, 3
#: Shards of less than SHARE occurrences of `support` report by hash; lengths from TURN on come in the second turn.
SHARE, TURN = 3, 3
#: Bits of a hash and of occurrences in such a report, and about how many bytes of text a part of the hashes stands for.
PREFIX, TIMES, PART = 40, 24, 8 << 20
# What ends a piece, and what parts words.
ENDS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

#: Which phrases go on: from their number of words, their hashes and their occurrences in the shard.
Passes = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


class Block:
    """The words of a shard as they follow each other, and the text that holds them one blank apart. It is filled slice by slice."""

    def __init__(self):
        self.size, self.words = 0, 0
        self._hash, self._lengths, self._left, self._text = [], [], [], []

    def add(self, data: np.ndarray, edges: np.ndarray) -> None:
        """Texts whose bytes lie between their edges."""
        starts, ends, of = spans(data, edges, flags(ENDS + BLANKS))
        self.size += len(data)
        self.words += len(starts)
        if not len(starts):
            return
        # A piece goes on as long as no end of one and no other text comes between.
        breaks = np.concatenate([[0], np.cumsum(flags(ENDS)[data], dtype=np.int32)])[starts] + of
        last = np.searchsorted(breaks, breaks, "right")
        self._left.append(np.minimum(last - np.arange(len(breaks)), 127).astype(np.int8))
        self._hash.append(hashes(data, starts, ends, 5))
        lengths = ends - starts
        self._lengths.append(lengths.astype(np.int32))
        after = np.cumsum(lengths + 1) - 1
        text = np.full(int(after[-1]) + 1, 0x20, np.uint8)
        inside = np.ones(len(text), bool)
        inside[after] = False
        text[inside] = data[~flags(ENDS + BLANKS)[data]]
        self._text.append(text)

    def take(self, more: Block) -> None:
        """The texts of another block, too."""
        self.size += more.size
        self.words += more.words
        for name in ("_hash", "_lengths", "_left", "_text"):
            setattr(self, name, getattr(self, name) + getattr(more, name))

    def full(self) -> Block:
        """Itself, ready to be mined."""
        if self.words:
            self.hash, self.left, self.text = (np.concatenate(x) for x in (self._hash, self._left, self._text))
            lengths = np.concatenate(self._lengths)
            self.end = np.cumsum(lengths + 1, dtype=np.int64 if len(self.text) >> 31 else np.int32) - 1
            self.start = self.end - lengths
        self._hash = self._lengths = self._left = self._text = []
        return self

    def phrases(self, at: np.ndarray, size: int) -> pa.Array:
        """The texts of the phrases of `size` words at the given words."""
        low, high = self.start[at].astype(np.int64), self.end[at + size - 1]
        lengths = high - low
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(low - offsets[:-1], lengths) + np.arange(offsets[-1])
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.text[place]))

    def levels(self, passes: Passes, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(words, hash, first place, occurrences) of the phrases that `passes(words, hash, occurrences)` lets through.

        A phrase is looked at where both phrases of one word less passed that make it up. Places are sorted by hash in
        PARTS parts, one after the other, to hold less at a time.
        """
        if not self.words:
            return
        good, key = np.ones(self.words + 1, bool), self.hash.copy()
        good[-1] = False
        for size in range(1, longest + 1):
            if size > 1:
                good[:-1] &= good[1:] & (self.left >= size)
                for low in range(0, self.words - size + 1, BYTES):
                    own = slice(low, min(low + BYTES, self.words - size + 1))
                    key[own] = mixed(key[own] * np.uint64(0x9E3779B97F4A7C15) + self.hash[own.start + size - 1 : own.stop + size - 1])
            at = np.flatnonzero(good[:-1]).astype(np.int32)
            good[:] = False
            part = (key[at] >> np.uint64(60)).astype(np.uint8) % PARTS
            for p in range(PARTS):
                own = at[part == p]
                if not len(own):
                    continue
                keys = key[own]
                order = np.argsort(keys, kind="stable")
                keys, own = keys[order], own[order]
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                times = np.diff(np.append(first, len(own)))
                ok = passes(size, keys[first], times)
                good[own[np.repeat(ok, times)]] = True
                if ok.any():
                    yield size, keys[first[ok]], own[first[ok]].astype(np.int64), times[ok]
            if not good.any():
                return


def _blocks(batches: Iterator[pa.RecordBatch], sizes: dict[str, int]) -> Iterator[tuple[str, Block]]:
    """A task's texts by language, in blocks of about the size of the language's; a small rest joins the block before it."""
    held: dict[str, list[Block]] = {}
    for batch in batches:
        for lang in pc.unique(batch["lang"]).to_pylist():
            own = held.setdefault(lang, [Block()])
            for _, _, data, edges in slices(batch.filter(pc.equal(batch["lang"], lang)), "text", min(BYTES, sizes[lang] // 8 + 1)):
                own[-1].add(data, edges)
                if own[-1].size >= sizes[lang]:
                    own.append(Block())
                    if len(own) > 2:
                        yield lang, own.pop(0).full()
    while held:
        lang, own = held.popitem()
        if len(own) > 1 and own[-1].size < sizes[lang] / 2:
            own[-2].take(own.pop())
        for found in own:
            yield lang, found.full()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), ascii_lower(F.coalesce("text", F.lit(""))).alias("text"))


def coded(key: np.ndarray, lang: str) -> np.ndarray:
    """What a filter takes for a phrase: the first PREFIX bits of its hash behind some of its language's."""
    return (key >> np.uint64(64 - PREFIX)) | np.uint64((zlib.crc32(lang.encode()) & ((1 << (64 - PREFIX)) - 1)) << PREFIX)


def _report(block: Block, lang: str, passes: Passes, longest: int, hashed: bool, extra: list[int]) -> Iterator[pa.RecordBatch]:
    for size, key, at, times in block.levels(passes, longest):
        n = len(at)
        columns = [pa.array([lang] * n, pa.string()), block.phrases(at, size), pa.array(times, pa.int64())]
        columns += [pa.array(coded(key, lang).view(np.int64))] if hashed else []
        columns += [pa.array(np.full(n, x), pa.int64()) for x in extra]
        names = ["lang", "phrase", "times", *(["key"] if hashed else []), *(["below"] if extra else [])]
        yield pa.RecordBatch.from_arrays(columns, names)


def _mined(rows: DataFrame, totals: dict[str, int], support: int, longest: int, sizes: dict[str, int]) -> DataFrame:
    """(lang, phrase, times, key, below): what each shard reports; below is the most that an unreported phrase has there.

    A row without a phrase tells `below` and, as times, the words of the shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, found in _blocks(batches, sizes):
            least = max(1, -(-support * found.size // totals[lang])) if totals[lang] else 1
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang]), "phrase": pa.array([None], pa.string()), "times": pa.array([found.words], pa.int64()), "key": pa.array([0], pa.int64()), "below": pa.array([least - 1], pa.int64())}
            )
            yield from _report(found, lang, lambda _, key, times, least=least: times >= least, longest, True, [least - 1])

    return rows.mapInArrow(run, "lang string, phrase string, times bigint, key bigint, below bigint")


def bits(keys: np.ndarray, size: int) -> list[np.ndarray]:
    """The places of hashes in a filter of `size` bits."""
    keys = keys.view(np.uint64)
    return [(mixed(keys + np.uint64(k)) % np.uint64(size)).astype(np.int64) for k in range(PLACES)]


def _set(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of 64 bits, and the bits in each, that the hashes set in a filter of `size` bits."""
    place = np.unique(np.concatenate(bits(keys, size)))
    first = np.flatnonzero(np.append(True, place[1:] >> 6 != place[:-1] >> 6)) if len(place) else place
    bit = np.uint64(1) << (place & 63).astype(np.uint64)
    return place[first] >> 6, np.bitwise_or.reduceat(bit, first).view(np.int64) if len(place) else place


def _joined(words: pa.Table, size: int) -> np.ndarray:
    """The filter of `size` bits whose words are given, of which there are size / 64."""
    out = np.zeros(size // 64, np.int64)
    for batch in words.to_batches():
        out[batch["word"].to_numpy()] = batch["bits"].to_numpy()
    return out.view(np.uint8)


def _filter(candidates: DataFrame, size: int) -> np.ndarray:
    """The bit filter of the candidates' hashes, made in tasks and joined by words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _set(batch["key"].to_numpy(), size)], ["word", "bit"])

    words = candidates.select("key").mapInArrow(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    return _joined(words.toArrow(), size)


def _held(filter_: np.ndarray, size: int, key: np.ndarray, lang: str) -> np.ndarray:
    """Whether the filter of `size` bits passes the phrases of a language that have these hashes."""
    ok = np.ones(len(key), bool)
    for place in bits(coded(key, lang), size):
        ok &= (filter_[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return ok


def _counted(rows: DataFrame, filter_, size: int, longest: int, sizes: dict[str, int]) -> DataFrame:
    """(lang, phrase, times): all occurrences in each shard of the phrases that the filter passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filter_.value
        for lang, found in _blocks(batches, sizes):
            yield from _report(found, lang, lambda _, key, times, lang=lang: _held(held, size, key, lang), longest, False, [])

    return rows.mapInArrow(run, "lang string, phrase string, times bigint")


def packed(prefix: np.ndarray, times: np.ndarray) -> bytes:
    """Sorted first bits of hashes and the occurrences of each, which stop at the most that TIMES bits hold."""
    apart = np.diff(prefix, prepend=np.uint64(0)) << np.uint64(TIMES)
    both = apart | np.minimum(times, (1 << TIMES) - 1).astype(np.uint64)
    # Byte by byte of all numbers: those that are alike lie together.
    planes = np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T)
    return pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpacked(data: pa.Buffer | bytes, n: int) -> np.ndarray:
    """n numbers: the first bits of a hash above its occurrences."""
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, decompressed_size=8 * n), np.uint8).reshape(8, n)
    both = np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)
    low = np.uint64((1 << TIMES) - 1)
    return (np.cumsum(both >> np.uint64(TIMES), dtype=np.uint64) << np.uint64(TIMES)) | (both & low)


def _reports(rows: DataFrame, filter_, size: int, first: int, longest: int, sizes: dict[str, int], cuts: dict[str, int]) -> DataFrame:
    """(lang, part, n, data): the n phrases of `first` to `longest` words that each shard has in a part of the hashes.

    Of a language's hashes the first `cuts` bits name the part. Phrases of fewer than `first` words are those that the filter
    passes. A row without data tells, in the first turn, the words of the shard.
    """
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = filter_ and filter_.value
        for lang, found in _blocks(batches, sizes):
            if first == 1:
                yield pa.RecordBatch.from_pylist([{"lang": lang, "part": -1, "n": found.words}], schema)

            def passes(words: int, key: np.ndarray, times: np.ndarray, lang: str = lang) -> np.ndarray:
                return _held(held, size, key, lang) if words < first else np.ones(len(key), bool)

            for words, key, _, times in found.levels(passes, longest):
                if words < first:
                    continue
                prefix = key >> np.uint64(64 - PREFIX)
                part = prefix >> np.uint64(PREFIX - cuts[lang])
                edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
                ranges = list(zip(edges[:-1], edges[1:], strict=True))
                columns = [[lang] * len(ranges), part[edges[:-1]].astype(np.int32), np.diff(edges), [packed(prefix[i:j], times[i:j]) for i, j in ranges]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.mapInArrow(run, "lang string, part int, n bigint, data binary")


def _reached(found: list[np.ndarray], support: int) -> np.ndarray:
    """The first bits of the hashes whose occurrences in all reports of a part come to `support`."""
    both = np.concatenate(found)
    both.sort()
    prefix, most = both >> np.uint64(TIMES), (1 << TIMES) - 1
    times = (both & np.uint64(most)).astype(np.int64)
    # Where occurrences were stopped there may have been as many as are asked for.
    times[times == most] = max(most, support)
    first = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
    return prefix[first[np.add.reduceat(times, first) >= support]]


def _together(reports: DataFrame, support: int, size: int, tasks: int) -> tuple[np.ndarray, dict[str, int]]:
    """The filter of `size` bits of the phrases that reach `support` in all reports; and the words of each language."""
    schema = pa.schema([("lang", pa.string()), ("n", pa.int64()), ("word", pa.int64()), ("bit", pa.int64())])

    def reached(lang: str, found: list[np.ndarray]) -> pa.RecordBatch:
        word, bit = _set(coded(_reached(found, support) << np.uint64(64 - PREFIX), lang), size)
        return pa.RecordBatch.from_arrays([pa.nulls(len(word), pa.string()), pa.nulls(len(word), pa.int64()), pa.array(word), pa.array(bit)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, found = None, []
        for batch in batches:
            for lang, part, n, data in zip(batch["lang"].to_pylist(), batch["part"].to_pylist(), batch["n"].to_pylist(), batch["data"], strict=True):
                if part < 0:
                    yield pa.RecordBatch.from_pylist([{"lang": lang, "n": n}], schema)
                    continue
                if found and of != (lang, part):
                    yield reached(of[0], found)
                    found = []
                of = lang, part
                found.append(unpacked(data.as_buffer(), n))
        if found:
            yield reached(of[0], found)

    parts = reports.repartition(tasks, "lang", "part").sortWithinPartitions("lang", "part")
    with shuffles_freed(reports.sparkSession):
        out = parts.mapInArrow(run, "lang string, n bigint, word bigint, bit bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.bit_or("bit").alias("bits")).toArrow()
    of_lang = out.filter(pc.is_null(out["word"]))
    return _joined(out.filter(pc.is_valid(out["word"])), size), dict(zip(of_lang["lang"].to_pylist(), of_lang["n"].to_pylist(), strict=True))


def _by_hash(rows: DataFrame, of_lang: dict[str, int], support: int, longest: int, sizes: dict[str, int], tasks: int, filter_bits: int) -> tuple[np.ndarray, DataFrame]:
    """The filter of the phrases that may reach `support`, from shards that report by hash; and (lang, n), the words of each language."""
    spark = rows.sparkSession
    cuts = {lang: min(PREFIX // 2, max(4, (n // PART).bit_length())) for lang, n in of_lang.items()}
    out, words = _together(_reports(rows, None, filter_bits, 1, min(TURN - 1, longest), sizes, cuts), support, filter_bits, tasks)
    if longest >= TURN:
        filter_ = spark.sparkContext.broadcast(out)
        out = out | _together(_reports(rows, filter_, filter_bits, TURN, longest, sizes, cuts), support, filter_bits, tasks)[0]
        filter_.unpersist()
    return out, spark.createDataFrame([*words.items()], "lang string, n bigint")


def _by_phrase(rows: DataFrame, of_lang: dict[str, int], support: int, longest: int, sizes: dict[str, int], filter_bits: int) -> tuple[np.ndarray, DataFrame]:
    """The filter of the phrases that may reach `support`, from what shards report; and (lang, n), the words of each language."""
    found = written(_mined(rows, of_lang, support, longest, sizes))
    shards = written(found.filter("phrase is null").groupBy("lang").agg(F.sum("below").alias("all_below"), F.sum("times").alias("n")))
    reported = found.filter("phrase is not null").groupBy("lang", "phrase").agg(F.sum("times").alias("times"), F.sum("below").alias("below"), F.any_value("key").alias("key"))
    bound = F.col("times") + F.col("all_below") - F.col("below")
    candidates = written(reported.join(shards.select("lang", "all_below"), "lang").filter(bound >= support).select("lang", "phrase", "key"))
    remove(found)
    filter_ = _filter(candidates, filter_bits)
    remove(candidates)
    return filter_, shards.select("lang", "n")


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, block: int = BLOCK, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a): all phrases of 1 to `longest` words with `support` occurrences or more; and (lang, n), the words of each language."""
    spark, rows = docs.sparkSession, _rows(docs)
    # One row a language.
    of_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    sizes = {lang: min(block, -(-n // SHARDS)) for lang, n in of_lang.items()}
    tasks = max(SHARDS, -(-sum(of_lang.values()) // block))
    if rows.rdd.getNumPartitions() > tasks:
        rows = rows.coalesce(tasks)
    shards = max([min(tasks, rows.rdd.getNumPartitions()), *(-(-n // sizes[lang]) for lang, n in of_lang.items() if n)])
    if support < SHARE * shards:
        candidates, words = _by_hash(rows, of_lang, support, longest, sizes, tasks, filter_bits)
    else:
        candidates, words = _by_phrase(rows, of_lang, support, longest, sizes, filter_bits)
    filter_ = spark.sparkContext.broadcast(candidates)
    counts = _counted(rows, filter_, filter_bits, longest, sizes).groupBy("lang", "phrase").agg(F.sum("times").alias("a"))
    return written(counts.filter(F.col("a") >= support)), words


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, **options) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, sizes = frequent(docs, support, longest, **options)
    words = F.split("phrase", " ")
    own = phrases.withColumn("w", words).withColumn("size", F.size("w"))
    several = own.filter("size > 1")
    whole = "decimal(38,0)"
    cut = several.select("lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("one"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("two"))
    one = phrases.select("lang", F.col("phrase").alias("one"), F.col("a").alias("l"))
    two = phrases.select("lang", F.col("phrase").alias("two"), F.col("a").alias("r"))
    cut = cut.join(one, ["lang", "one"]).join(two, ["lang", "two"]).join(sizes, "lang")
    above = F.col("a").cast("decimal(18,0)") * F.col("n").cast("decimal(17,0)") * F.lit(1000).cast("decimal(4,0)")
    below = F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(18,0)")
    score = F.call_function("div", above.cast(whole), below.cast(whole))
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    # A phrase as frequent as one around it goes; one word more is enough, as frequencies only fall with length.
    longer = several.filter("size > 2").select("lang", "a", F.explode(F.array(F.array_join(F.slice("w", F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    inside = longer.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter("around is null or 100 * around < 100 * a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "b.l", "b.r", "n", "b.score")


def oracle() -> str:
    ends = r"[.,;:!?\x0A-\x0D]"
    sizes = ", ".join(str(k) for k in range(1, LONGEST + 1))
    return f"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ends}')) as p from documents
    ), words as materialized (
        select lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda w: w <> '') as w from pieces
    ), sizes as (
        select lang, cast(sum(len(w)) as bigint) as n from words group by lang
    ), f as materialized (
        select lang, x as w, len(x) as size, array_to_string(x, ' ') as phrase, count(*) as a
        from (select lang, w[s : s + k - 1] as x from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as s from words, (select unnest([{sizes}]) as k)))
        group by lang, x having count(*) >= {SUPPORT}
    ), cuts as (
        select lang, phrase, a, w, size, unnest(range(1, size)) as k from f where size > 1
    ), scored as (
        select c.lang, c.phrase, c.a, c.k, l.a as l, r.a as r, s.n, cast((1000 * cast(c.a as hugeint) * s.n) // (cast(l.a as hugeint) * r.a) as bigint) as score
        from cuts c join f l on l.lang = c.lang and l.w = c.w[1 : c.k] join f r on r.lang = c.lang and r.w = c.w[c.k + 1 : c.size] join sizes s on s.lang = c.lang
    ), best as (
        select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), covered as (
        select distinct lang, x as phrase, a from (
            select lang, a, array_to_string(w[s : s + k - 1], ' ') as x
            from (select lang, a, w, k, unnest(range(1, size - k + 2)) as s from f, (select unnest([{sizes}]) as k) where k > 1 and k < size)
        )
    )
    select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, n, score
    from best anti join covered using (lang, phrase, a) qualify rank <= {TOP}
    """
