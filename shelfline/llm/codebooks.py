"""Compression of vectors to codes: k-means of each part of the vectors, in whole numbers, with adaptive bounds.

Every part of every vector keeps, in a written table, its entry with an upper bound of its distance, the `b` closest other
entries with a lower bound each, in order, and one outer lower bound for all entries beyond them. When entries move, the
bounds move with them (Drake and Hamerly). A part whose upper bound stays below all lower bounds keeps its entry unseen. If
not, its own distance is computed; if it still reaches a listed bound, the listed entries are compared, and if it reaches
the outer bound, all entries are and the list is made anew. These comparisons are of whole numbers, ties go to the lower
index, and bounds carry a margin above the rounding of doubles, so entries are always those of a full search. After each
round `b` becomes what the part's vectors needed at most, between 1 and all entries but one.

Driver and tasks share the codebooks only: `entries` times the length of a vector, both parameters and not of the data's
size. Sums of a round are combined in each task before they meet.

Vectors that are null or hold null or non-finite components are dropped; an empty table, or one without other vectors,
gives an empty result. Rows that repeat a vec_id are each a row; the first codebooks take rows by vec_id (nulls last), then
by vector. Fewer rows than entries make fewer entries. Vectors of unlike lengths, lengths that the parts don't divide, and
components beyond 2^24 raise an error. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.scratch import remove, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Whole components stay below this, so that squared distances are exact in 64 bits and in doubles.
GREATEST = 1 << 24
#: What rounding may take from a bound, relative and absolute.
MARGIN = 1e-9
#: Components that are compared with all entries at a time: the bound of a task's memory.
AT_ONCE = 1 << 18

STATE = "vec_id bigint, label string, v array<int>, entry array<int>, upper array<double>, listed array<int>, lower array<double>, outer array<double>, error bigint, need array<int>"


@dataclass
class Bounds:
    """Of the vectors of a batch in one part: all arrays have a row each; `listed` and `lower` b columns."""

    entry: np.ndarray
    upper: np.ndarray
    listed: np.ndarray
    lower: np.ndarray
    outer: np.ndarray


def _squares(x: np.ndarray, book: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Squared distances of each row of x to the entries that its row of `of` names."""
    apart = x[:, None, :] - book[of]
    return np.einsum("ijk,ijk->ij", apart, apart)


def _ranked(squares: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and squares of each row by square, then name."""
    order = np.lexsort((names, squares), axis=1)
    return np.take_along_axis(names, order, 1), np.take_along_axis(squares, order, 1)


def full_search(x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    names, squares = _ranked(_squares(x, book, np.tile(np.arange(len(book)), (len(x), 1))), np.tile(np.arange(len(book)), (len(x), 1)))
    away = np.sqrt(squares)
    outer = away[:, b + 1] if b + 1 < len(book) else np.full(len(x), np.inf)
    return Bounds(names[:, 0], away[:, 0], names[:, 1 : b + 1], away[:, 1 : b + 1], outer)


def moved(x: np.ndarray, book: np.ndarray, drift: np.ndarray, old: Bounds) -> tuple[Bounds, np.ndarray]:
    """The bounds after every entry moved by `drift`, and how many listed entries each row needed."""
    b = old.listed.shape[1]
    entry, listed = old.entry.copy(), old.listed.copy()
    upper = (old.upper + drift[entry]) * (1 + MARGIN) + MARGIN
    lower = (old.lower - drift[listed]) * (1 - MARGIN) - MARGIN
    outer = (old.outer - drift.max(initial=0)) * (1 - MARGIN) - MARGIN
    need = np.zeros(len(x), np.int32)
    nearest = np.minimum(lower.min(axis=1, initial=np.inf), outer)
    # The part's own distance first.
    some = np.flatnonzero(upper >= nearest)
    upper[some] = np.sqrt(_squares(x[some], book, entry[some, None])[:, 0]) * (1 + MARGIN)
    some = some[upper[some] >= nearest[some]]
    need[some] = (lower[some] <= upper[some, None]).sum(axis=1)
    # Then the listed entries, where no other can be as near.
    near = some[upper[some] < outer[some]]
    if len(near):
        names = np.column_stack([entry[near], listed[near]])
        names, squares = _ranked(_squares(x[near], book, names), names)
        away = np.sqrt(squares)
        entry[near], upper[near], listed[near], lower[near] = names[:, 0], away[:, 0], names[:, 1:], away[:, 1:]
    # Then all.
    far = some[upper[some] >= outer[some]]
    if len(far):
        found = full_search(x[far], book, b)
        entry[far], upper[far], listed[far], lower[far], outer[far] = found.entry, found.upper, found.listed, found.lower, found.outer
        need[far] = b + 1
    order = np.argsort(lower, axis=1, kind="stable")
    return Bounds(entry, upper, np.take_along_axis(listed, order, 1), np.take_along_axis(lower, order, 1), outer), need


def listed_at(x: np.ndarray, book: np.ndarray, bounds: Bounds, b: int) -> Bounds:
    """Lists of b entries: the rest joins the outer bound; longer lists come from a full search."""
    have = bounds.listed.shape[1]
    if b > have:
        return full_search(x, book, b)
    outer = np.minimum(bounds.outer, bounds.lower[:, b:].min(axis=1, initial=np.inf))
    return Bounds(bounds.entry, bounds.upper, bounds.listed[:, :b], bounds.lower[:, :b], outer)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list for each row of a matrix."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(offsets, pa.array(rows.reshape(-1), kind))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n)


def _searched(books: np.ndarray, before: np.ndarray | None, sizes: list[int], had: list[int], parts: int):
    """A task's work in one round. books: (part, entry, place); before: the books that the stored bounds belong to.

    sizes and had: the length of the lists of each part, from now on and as stored.
    """
    drift = None if before is None else np.sqrt(((books - before) ** 2).sum(axis=2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, AT_ONCE // (parts * books.shape[2]))
        for batch in (b.slice(k, rows) for b in batches for k in range(0, b.num_rows, rows)):
            n = batch.num_rows
            v = _matrix(batch["v"], n).astype(np.int64)
            x = v.reshape(n, parts, books.shape[2])
            if drift is not None:
                stored = {c: _matrix(batch[c], n) for c in ("entry", "upper", "outer", "listed", "lower")}
                edges = np.cumsum([0, *had])
            found, needs, error = [], [], np.zeros(n, np.int64)
            for p in range(parts):
                if drift is None:
                    bounds, need = full_search(x[:, p], books[p], sizes[p]), np.full(n, sizes[p], np.int32)
                else:
                    a, z = edges[p : p + 2]
                    old = Bounds(stored["entry"][:, p], stored["upper"][:, p], stored["listed"][:, a:z], stored["lower"][:, a:z], stored["outer"][:, p])
                    bounds, need = moved(x[:, p], books[p], drift[p], listed_at(x[:, p], before[p], old, sizes[p]))
                apart = x[:, p] - books[p][bounds.entry]
                error += (apart * apart).sum(axis=1)
                found.append(bounds)
                needs.append(need)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["vec_id"],
                    batch["label"],
                    batch["v"],
                    _lists(np.column_stack([f.entry for f in found]), pa.int32()),
                    _lists(np.column_stack([f.upper for f in found]), pa.float64()),
                    _lists(np.hstack([f.listed for f in found]), pa.int32()),
                    _lists(np.hstack([f.lower for f in found]), pa.float64()),
                    _lists(np.column_stack([f.outer for f in found]), pa.float64()),
                    pa.array(error, pa.int64()),
                    _lists(np.column_stack(needs), pa.int32()),
                ],
                ["vec_id", "label", "v", "entry", "upper", "listed", "lower", "outer", "error", "need"],
            )

    return run


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v) of the vectors without null or non-finite components, which become floor(scale * x)."""
    held = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x):
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double")) * scale < GREATEST, y).otherwise(F.raise_error(F.lit("a component is too large"))).cast("int")

    return vectors.filter(F.coalesce(held, F.lit(False))).select("vec_id", F.col("label").cast("string").alias("label"), F.transform("embedding", whole).alias("v"))


@dataclass
class Codebooks:
    """books: (part, entry, place); state: the vectors with their entries and bounds; sizes: the b of each part by round."""

    books: np.ndarray
    state: DataFrame
    sizes: list[list[int]]

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.reshape(-1).tolist())).encode()).hexdigest()


def fitted(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks after the rounds, with the vectors assigned to them; None if no vector is held."""
    rows = written(whole_vectors(vectors, scale))
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    width = len(first[0]["v"])
    lengths = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if lengths[0] != lengths[1] or width % parts or not width:
        raise ValueError(f"vectors have {lengths[0]} to {lengths[1]} components, to be cut into {parts} equal parts")
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    most = len(first) - 1
    state, before, had, sizes = rows, None, [], [[min(most, max(1, entries // 4))] * parts]
    for turn in range(rounds + 1):
        now = written(state.mapInArrow(_searched(books, before, sizes[-1], had, parts), STATE))
        remove(state)
        state, had = now, sizes[-1]
        if turn == rounds:
            break
        # What the vectors of each part needed at most is how long its lists are next time.
        needed = now.select(*[F.max(F.get("need", F.lit(p))).alias(str(p)) for p in range(parts)]).first()
        sizes.append([min(most, max(1, n)) for n in needed])
        before, books = books, books.copy()
        part = F.call_function("div", F.col("pos"), F.lit(width // parts)).cast("int")
        sums = now.select("entry", F.posexplode("v").alias("pos", "x")).groupBy("pos", F.get("entry", part).alias("e")).agg(F.sum("x").alias("total"), F.count("*").alias("n"))
        for row in sums.collect():
            p, place = divmod(row["pos"], width // parts)
            books[p, row["e"], place] = row["total"] // row["n"]
    return Codebooks(books, state, sizes)


def codes(vectors: DataFrame, **options) -> DataFrame:
    """Per held vector: vec_id, label, code (two hex digits for each part), error, label_error, codebooks_sha256."""
    book = fitted(vectors, **options)
    if book is None:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, label string, code string, error bigint, label_error bigint, codebooks_sha256 string")
    code = F.array_join(F.transform("entry", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    coded = book.state.select("vec_id", "label", code.alias("code"), "error")
    # One row a label meets the vectors; a label with many vectors is on the side that Spark can split.
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of")), "left").drop("of").withColumn("codebooks_sha256", F.lit(book.digest()))


def decoded(coded: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """coded with `vector`: the components that the codes stand for."""
    table = F.array(*[F.array(*[F.array(*[F.lit(x / scale) for x in entry]) for entry in part]) for part in books.tolist()])
    indexes = F.sequence(F.lit(0), F.lit(len(books) - 1))
    at = F.transform(indexes, lambda p: F.get(F.get(table, p), F.conv(F.substring("code", p * 2 + 1, 2), 16, 10).cast("int")))
    return coded.withColumn("vector", F.flatten(at))


def oracle() -> str:
    steps = [
        f"kept as (select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v from embeddings"
        " where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"x as materialized (select r, cast((i - 1) // (len(v) // {PARTS}) as int) as part, cast((i - 1) % (len(v) // {PARTS}) as int) as place, v[i] as x from (select r, v, unnest(range(1, len(v) + 1)) as i from kept))",
        f"c0 as materialized (select part, cast(r - 1 as int) as e, place, x as c from x where r <= {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"d{k} as (select r, part, e, sum((x - c) * (x - c)) as d from x join c{k} using (part, place) group by all)")
        steps.append(f"a{k} as materialized (select r, part, min(d) as d, arg_min(e, (d, e)) as e from d{k} group by all)")
        if k < ROUNDS:
            steps.append(
                f"c{k + 1} as materialized (select c.part, c.e, c.place, coalesce(m.m, c.c) as c from c{k} c left join"
                f" (select part, e, place, cast(floor(sum(x) / count(*)) as bigint) as m from x join a{k} using (r, part) group by all) m using (part, e, place))"
            )
    last = ROUNDS
    steps += [
        f"codes as (select r, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by part) as code, cast(sum(d) as bigint) as error from a{last} group by r)",
        f"digest as (select sha256(string_agg(cast(c as varchar), ',' order by part, e, place)) as codebooks_sha256 from c{last})",
    ]
    return (
        "with " + ", ".join(steps) + " select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256"
        " from codes join kept using (r) cross join digest"
    )
