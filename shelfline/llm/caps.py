"""Near-duplicate vectors by spherical-cap filters.

Vectors are scaled to length one, rotated at random and cut into two blocks, each with a random code
of unit directions, and this several times over. A filter is a pair of code words; a vector passes all filters whose two inner
products add up to at least the cap's height. List decoding finds them without trying every pair: a
code word takes part only if it reaches the height with the other block's best. Vectors that pass a
filter in common meet in blocks of bounded size; bit sketches drop pairs far below the threshold, the
cosine in double precision decides the others. Links are counted there, so no row stands for a pair.

Code words grow with the square root of the vectors, so a filter holds a constant number of
unrelated vectors; the height is set so that a random vector passes `filters` of them on average in
each code. How many a vector passes differs widely between codes, which is why there are several.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do
rows without an id (component null). Equal vectors are one node, with as many links as copies.
Repeated ids are vectors of their own. Vectors of different lengths never link. An empty table gives
an empty result. Columns other than the two named are not read. Kept: vec_id = component_id, true
for rows without an id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import blocks
from shelfline.llm.graph import components
from shelfline.llm.scratch import written


@dataclass(frozen=True)
class Params:
    """most_bits: sketch bits (of 64) in which a pair may differ; at 0.95 it is 6.5, give or take 2.4."""

    cosine: float = 0.95
    codes: int = 5
    filters: float = 8.0
    most_bits: int = 20
    seed: int = 5


def code_words(n: int) -> int:
    """Per block: a power of two whose square is at least four times n, 64 at least."""
    return 1 << max(6, math.ceil(math.log2(max(n, 1)) / 2 + 1))


def code(size: int, words: int, p: Params, number: int):
    """Rotation, the two blocks' code words, sketch directions and cap height for vectors of `size` components."""
    rng = np.random.default_rng([p.seed, size, number])
    wide = max(16, size + size % 2)
    rotation = np.linalg.qr(rng.standard_normal((wide, wide)))[0][:size]
    blocks = rng.standard_normal((2, words, wide // 2))
    blocks /= np.linalg.norm(blocks, axis=2, keepdims=True) * math.sqrt(2)
    directions = rng.standard_normal((wide, 64))
    probes = rng.standard_normal((200, wide))
    probes /= np.linalg.norm(probes, axis=1, keepdims=True)
    first, second = probes[:, : wide // 2] @ blocks[0].T, np.sort(probes[:, wide // 2 :] @ blocks[1].T, axis=1)
    low, high = 0.0, 1.0
    for _ in range(20):
        height = (low + high) / 2
        passed = sum(words - np.searchsorted(s, height - f) for f, s in zip(first, second, strict=True)).sum() / len(probes)
        low, high = (height, high) if passed > p.filters else (low, height)
    return rotation, blocks, directions, low


def decode(vectors: np.ndarray, words: int, codes: list[tuple]) -> tuple[list[np.ndarray], np.ndarray]:
    """The numbers of all filters that each unit vector passes in its codes, and its sketch by the first one."""
    found: list[list[np.ndarray]] = [[] for _ in vectors]
    for number, (rotation, blocks, _, height) in enumerate(codes):
        x = vectors @ rotation
        half = x.shape[1] // 2
        first, second = x[:, :half] @ blocks[0].T, x[:, half:] @ blocks[1].T
        for k, (f, s) in enumerate(zip(first, second, strict=True)):
            i, j = np.flatnonzero(f >= height - s.max()), np.flatnonzero(s >= height - f.max())
            at, to = np.nonzero(f[i][:, None] + s[j] >= height)
            found[k].append((number * words + i[at].astype(np.int64)) * words + j[to])
    rotation, _, directions, _ = codes[0]
    sketch = np.packbits(vectors @ rotation @ directions > 0, axis=1).view(np.int64).ravel()
    return [np.concatenate(numbers) for numbers in found], sketch


def _coded(words: int, p: Params):
    """A Pandas UDF from vectors to filters and sketch."""

    @F.pandas_udf("filters array<bigint>, sketch bigint")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codes: dict[int, list[tuple]] = {}
        for batch in batches:
            filters, sketch = [None] * len(batch), np.zeros(len(batch), np.int64)
            sizes = batch.map(len).to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if size not in codes:
                    codes[size] = [code(int(size), words, p, k) for k in range(p.codes)]
                for part in np.array_split(at, math.ceil(len(at) * words / 1_000_000)):
                    x = np.stack(batch.iloc[part].to_list()).astype(np.float64)
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    lists, bits = decode(x, words, codes[size])
                    sketch[part] = bits
                    for k, numbers in zip(part, lists, strict=True):
                        filters[k] = numbers
            yield pd.DataFrame({"filters": filters, "sketch": sketch})

    return coded


def _crowded(entries: DataFrame, keys: list[str]) -> DataFrame:
    """entries (node, filter, size, ...) that share a filter with others, dealt to pairs of chunks (i <= j): columns i, j, own."""
    count = entries.groupBy("filter", "size").agg(F.count("*").alias("n")).filter("n > 1").select("filter", "size", blocks.chunks("n").alias("g"))
    placed = entries.join(count, ["filter", "size"]).withColumn("own", blocks.chunk("node", F.col("g")))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return placed.select(*keys, F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own")


def _met(group: pd.DataFrame) -> np.ndarray:
    """Which pairs of the group are compared in it: across its two chunks, or within its only one."""
    own = group["own"].to_numpy()
    pairs = ~np.eye(len(own), dtype=bool)
    return pairs if group["i"].iloc[0] == group["j"].iloc[0] else pairs & (own[:, None] != own)


def links(classes: DataFrame, p: Params) -> DataFrame:
    """Of classes (node, copies, e: array<double>) that share filters: rows (node, other, others).

    others: how many vectors one of the node's groups links it with, each pair counted in the first
    filter it shares. other, unless -1: links that join all that is linked in the group.
    Sketches tell first who has a candidate in a filter, and only these bring their vectors there.
    """
    words, keys = code_words(classes.count()), ["filter", "size", "i", "j"]
    coded = classes.select("node", F.size("e").alias("size"), _coded(words, p)("e").alias("c"))
    entries = written(coded.select("node", "size", F.col("c.sketch").alias("sketch"), F.explode("c.filters").alias("filter")))
    most_bits, threshold = p.most_bits, p.cosine

    def compared(group: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(group["e"].to_list())
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sketch, node = group["sketch"].to_numpy().view(np.uint64), group["node"].to_numpy()
        linked = _met(group) & (x @ x.T >= threshold) & (np.bitwise_count(sketch[:, None] ^ sketch) <= most_bits)
        linked &= linked.T
        at, to = blocks.forest(linked)
        before = [np.asarray(f, np.int64) for f in group["filters"]]
        before = [f[f < k] for f, k in zip(before, group["filter"], strict=True)]
        new = linked & (blocks.intersections(before, before) == 0)
        others = new @ group["copies"].to_numpy()
        some = np.flatnonzero(others)
        none = np.full(len(some), -1)
        return pd.DataFrame({"node": np.append(node[some], node[at]), "other": np.append(none, node[to]),
                             "others": np.append(others[some], np.zeros(len(at), np.int64))})

    members = _crowded(entries, [*keys[:2], "node", "sketch"]).groupBy(keys).agg(F.collect_list(F.struct("node", "sketch", "own")).alias("m"))
    some = (
        "transform(filter(m, x -> exists(m, y -> x.node <> y.node and (i = j or x.own <> y.own)"
        f" and bit_count(x.sketch ^ y.sketch) <= {most_bits})), x -> x.node)"
    )
    near = written(members.select("filter", "size", F.explode(F.expr(some)).alias("node")).distinct())
    lists = near.groupBy("node").agg(F.sort_array(F.collect_list("filter")).alias("filters"))
    full = lists.join(classes.select("node", "copies", "e"), "node").join(entries.select("node", "sketch").distinct(), "node")
    dealt = _crowded(near, [*keys[:2], "node"]).join(full, "node")
    return written(blocks.in_groups(dealt, keys, compared, "node bigint, other bigint, others bigint"))


def groups(vectors: DataFrame, p: Params = Params(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest id reachable) and kept."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    sound = F.expr(
        "vec_id is not null and size(e) > 0 and forall(e, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(e, x -> x <> 0)"
    )
    print_ = F.when(F.coalesce(sound, F.lit(False)), F.struct(F.xxhash64("e").alias("x"), F.xxhash64(F.lit(p.seed), "e").alias("y")))
    rows = rows.withColumn("print", print_)
    classes = rows.filter("print is not null").groupBy("print").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("e").alias("e"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    found = links(classes.select("node", "copies", "e"), p)
    degree = found.groupBy("node").agg(F.sum("others").alias("others"))
    joined = found.filter("other >= 0").select(F.col("node").alias("a"), F.col("other").alias("b"))
    of = components(joined).withColumnRenamed("id", "node")
    known = classes.select("print", "node", "first", "copies").join(of, "node", "left").join(degree, "node", "left")
    known = written(known.withColumn("component", F.coalesce("component", "node")))
    least = known.groupBy("component").agg(F.min("first").alias("least"))
    n = F.col("copies") - 1 + F.coalesce("others", F.lit(0))
    known = known.join(least, "component").select("print", n.alias("n_links"), "least")
    component = F.coalesce("least", "vec_id")
    return rows.select("vec_id", "print").join(known, "print", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
