"""SentencePiece unigram encoding and decoding.

The best segmentation is found by Viterbi over a double-array trie of the pieces. Characters that no
piece covers fall back to byte pieces. Spaces are written as the marker U+2581, with one before the
text; decoding undoes both. A marker that is in the text itself is written as bytes, so every text
comes back as it was.

No piece holds a marker behind another character, so the best path always passes the borders in
front of markers: the runs between them that differ are encoded side by side, in numpy. Runs are
told apart by hashes; ids are decoded again and compared with the text, and a text that fails, that
holds a marker, or whose run is long goes through `Coder`, one step after the other. Of equal paths
the one whose last piece starts first is taken.

Log scores follow from a piece's rank in the vocabulary by Zipf's law, as the vocabulary file has
ranks only. Null and empty texts have no ids. A text of any length is encoded whole. Repeated rows
give repeated rows and an empty table an empty one; only `text` and the columns to keep are read.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.wordprints import hashes, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Runs up to so many bytes are encoded side by side, in tables of so many cells: the bound of a task's memory for them.
LONGEST, CELLS = 128, 1 << 18
#: Bytes of texts that are encoded together.
SLICE = 1 << 21
COLUMNS = ["n_pieces", "n_byte_pieces", "round_trip", "ids"]


class Vocabulary(NamedTuple):
    """pieces: text by id, None for control and byte pieces. bytes_: id of each byte. Trie: see `double_array`."""

    pieces: list[str | None]
    scores: list[float]
    bytes_: list[int]
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def double_array(keys: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A trie as arrays: the child of state s by byte c is t = base[s] + c + 1 if check[t] == s; value[t] is a key's id or -1."""
    tree: dict = {}
    for key, number in keys.items():
        node = tree
        for c in key:
            node = node.setdefault(c, {})
        node[-1] = number
    size = 1 << 16
    base, check, value = (np.full(size, fill, np.int32) for fill in (0, -1, -1))
    used = bytearray(size)
    check[0], used[0], free, queue = 0, 1, 1, [(0, tree)]
    while queue:
        state, node = queue.pop()
        value[state] = node.pop(-1, -1)
        if not node:
            continue
        codes = [c + 1 for c in node]
        free, least = used.find(0, free), min(codes)
        # The first free place that as the least child's leaves room for the others.
        place = max(free, least)
        while True:
            if place + 512 >= size:
                base, check, value = (np.concatenate([x, np.full(size, fill, np.int32)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
                used += bytes(size)
                size *= 2
            place = used.find(0, place)
            at = place - least
            if not any(used[at + c] for c in codes):
                break
            place += 1
        base[state] = at
        for c in codes:
            used[at + c] = 1
            check[at + c] = state
        queue += [(at + c + 1, child) for c, child in node.items()]
    return base, check, value


@lru_cache(maxsize=2)
def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file, with Zipf log scores by rank."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.vocab_size())
    byte_id = {model.id_to_piece(i): i for i in ids if model.is_byte(i)}
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces: list[str | None] = [None] * len(ids)
    for i in plain:
        pieces[i] = model.id_to_piece(i)
        if MARK in pieces[i].lstrip(MARK):
            raise ValueError(f"piece {i} of {path} has a marker behind another character")
    harmonic = sum(1 / k for k in range(1, len(plain) + 1))
    scores = [0.0] * len(ids)
    for rank, i in enumerate(sorted(plain, key=lambda i: (-model.get_score(i), i)), 1):
        scores[i] = float(np.float32(-math.log(rank * harmonic)))
    trie = double_array({pieces[i].encode(): i for i in plain})
    return Vocabulary(pieces, scores, [byte_id[f"<0x{b:02X}>"] for b in range(256)], *trie)


class Coder:
    """Encodes and decodes one text after the other."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.base, self.check, self.value = (x.tolist() for x in (vocabulary.base, vocabulary.check, vocabulary.value))
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.of_byte = {i: b for b, i in enumerate(vocabulary.bytes_)}
        self.mark_ids = [vocabulary.bytes_[b] for b in MARK.encode()]
        self.runs = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def best(self, run: str) -> list[int]:
        """Viterbi: the piece ids of the path with the greatest sum of log scores."""
        data, (base, check, value, scores) = run.encode(), (self.base, self.check, self.value, self.v.scores)
        n, size = len(data), len(check)
        total, start, piece = [-math.inf] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        total[0], at = 0.0, 0
        for char in run:
            width = len(char.encode())
            here, state, single = total[at], 0, False
            for end in range(at, n):
                child = base[state] + data[end] + 1
                if child >= size or check[child] != state:
                    break
                state, found = child, value[child]
                if found >= 0:
                    reached = end + 1
                    single |= reached == at + width
                    if here + scores[found] > total[reached]:
                        total[reached], start[reached], piece[reached] = here + scores[found], at, found
            if not single and here + self.unknown > total[at + width]:
                total[at + width], start[at + width], piece[at + width] = here + self.unknown, at, -1
            at += width
        path, end = [], n
        while end:
            if piece[end] >= 0:
                path.append(piece[end])
            else:
                path += [self.v.bytes_[b] for b in reversed(data[start[end] : end])]
            end = start[end]
        return path[::-1]

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        first, *rest = text.split(MARK)
        ids = self._runs(MARK + first.replace(" ", MARK))
        for part in rest:
            ids += self.mark_ids
            ids += self._runs(part.replace(" ", MARK))
        return ids

    def _runs(self, marked: str) -> list[int]:
        return list(itertools.chain.from_iterable(map(self.best, self.runs.findall(marked))))

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        if self.of_byte.keys().isdisjoint(ids):
            return "".join(map(self.v.pieces.__getitem__, ids)).replace(MARK, " ")[1:]
        out = bytearray()
        for i in ids:
            byte = self.of_byte.get(i)
            out += self.v.pieces[i].replace(MARK, " ").encode() if byte is None else bytes((byte,))
        return out.decode(errors="replace")[1:]


def _looked_up(v: Vocabulary) -> dict[str, np.ndarray]:
    """Arrays for many runs at a time: the trie with room behind its end, scores by id, and the bytes of each piece."""
    room = np.zeros(258, np.int32)
    as_bytes = [b"" if p is None else p.encode() for p in v.pieces]
    for byte, i in enumerate(v.bytes_):
        as_bytes[i] = bytes((byte,))
    lengths = np.array([len(p) for p in as_bytes], np.int64)
    return {
        "base": np.append(v.base, room),
        "check": np.append(v.check, room - 1),
        "value": np.append(v.value, room - 1),
        "scores": np.array(v.scores),
        "bytes": np.array(v.bytes_, np.int32),
        "is_byte": np.isin(np.arange(len(as_bytes)), v.bytes_),
        "text": np.frombuffer(b"".join(as_bytes), np.uint8),
        "at": np.cumsum(lengths) - lengths,
        "length": lengths,
    }


def best_paths(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, t: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi of many runs side by side: the ids of all best paths in a row, and how many each run has.

    The runs lie in `data`, the longest first. Ties go as in `Coder.best`: to the earliest start.
    """
    n, width = len(starts), int(lengths[0])
    base, check, value, scores = t["base"], t["check"], t["value"], t["scores"]
    unknown = scores.min() - UNKNOWN_PENALTY
    total = np.full((n, width + 1), -np.inf)
    start, piece = np.zeros((n, width + 1), np.int32), np.full((n, width + 1), -1, np.int32)
    total[:, 0] = 0.0
    longer = np.searchsorted(-lengths, -np.arange(width), "left")
    for p in range(width):
        rows = np.flatnonzero(total[: longer[p], p] > -np.inf)
        if not len(rows):
            continue
        first = data[starts[rows] + p]
        chars = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
        single, alive, state = np.zeros(len(rows), bool), np.arange(len(rows)), np.zeros(len(rows), np.int64)
        here = total[rows, p]
        for q in range(p, width):
            if q > p:
                kept = lengths[rows[alive]] > q
                alive, state = alive[kept], state[kept]
            child = base[state].astype(np.int64) + data[starts[rows[alive]] + q] + 1
            kept = check[child] == state
            alive, state = alive[kept], child[kept]
            if not len(alive):
                break
            found = value[state]
            ends = np.flatnonzero(found >= 0)
            who, found = alive[ends], found[ends]
            single[who] |= chars[who] == q + 1 - p
            score = here[who] + scores[found]
            better = score > total[rows[who], q + 1]
            at = rows[who[better]]
            total[at, q + 1], start[at, q + 1], piece[at, q + 1] = score[better], p, found[better]
        who = np.flatnonzero(~single)
        to = np.minimum(p + chars[who], lengths[rows[who]])
        better = here[who] + unknown > total[rows[who], to]
        at, to = rows[who[better]], to[better]
        total[at, to], start[at, to], piece[at, to] = here[who[better]] + unknown, p, -1
    # Back along the paths: each id stands at its first byte.
    ids, end, rows = np.full((n, width), -1, np.int32), lengths.copy(), np.arange(n)
    while len(rows):
        low, of = start[rows, end[rows]].astype(np.int64), piece[rows, end[rows]]
        ids[rows, low] = of
        for k in range(4):
            who = np.flatnonzero((of < 0) & (low + k < end[rows]))
            ids[rows[who], low[who] + k] = t["bytes"][data[starts[rows[who]] + low[who] + k]]
        end[rows] = low
        rows = rows[low > 0]
    held = ids >= 0
    return ids[held], held.sum(axis=1)


def _ragged(at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places at .. at + length of each pair, in a row."""
    filled = np.cumsum(lengths)
    return np.repeat(at - filled + lengths, lengths) + np.arange(filled[-1] if len(filled) else 0)


def encode_texts(texts: list[bytes], t: dict[str, np.ndarray], slow: Coder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids of all texts in a row, how many each has, and whether they decode to it. Runs that are equal are encoded once."""
    mark = MARK.encode()
    # Texts that hold a marker themselves go one by one.
    own = [mark in x for x in texts]
    marked = [b"" if odd or not x else mark + x.replace(b" ", mark) for x, odd in zip(texts, own, strict=True)]
    data = np.frombuffer(b"".join(marked), np.uint8)
    sizes = np.array([len(x) for x in marked], np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    ids, counts = np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    if len(data):
        at = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
        is_mark = np.zeros(len(data) + 3, bool)
        is_mark[at + 3] = True
        first = np.zeros(len(data), bool)
        first[edges[:-1][sizes > 0]] = True
        starts = at[~is_mark[at] | first[at]]
        ends = np.append(starts[1:], len(data))
        key = hashes(data, starts, ends, 7)
        _, where, which = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(-(ends - starts)[where], kind="stable")
        where, place = where[order], np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        which = place[which]
        lows, lengths, parts, n_of, low = starts[where], (ends - starts)[where], [], [], 0
        while low < len(where):
            if lengths[low] > LONGEST:
                run = np.array(slow.best(data[lows[low] : lows[low] + lengths[low]].tobytes().decode()), np.int32)
                parts.append(run)
                n_of.append(np.array([len(run)]))
                low += 1
                continue
            high = min(len(where), low + max(1, CELLS // int(lengths[low])))
            found, n = best_paths(data, lows[low:high], lengths[low:high], t)
            parts.append(found)
            n_of.append(n)
            low = high
        held, n = np.concatenate(parts), np.concatenate(n_of)
        ids = held[_ragged((np.cumsum(n) - n)[which], n[which])]
        run_of = np.searchsorted(edges, starts, "right") - 1
        counts = np.bincount(run_of, n[which], len(texts)).astype(np.int64)
    # What the ids stand for, byte by byte, against the texts.
    lengths = t["length"][ids]
    back = t["text"][_ragged(t["at"][ids], lengths)]
    filled = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
    if len(back) == len(data):
        wrong = np.concatenate([[0], np.cumsum(back != data)])
        same = (filled == edges)[1:] & (filled == edges)[:-1] & (wrong[edges[1:]] == wrong[edges[:-1]])
    else:
        same = np.zeros(len(texts), bool)
    again = np.flatnonzero(np.array(own) | ~same)
    if len(again):
        cut = np.concatenate([[0], np.cumsum(counts)])
        each = [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        for i in again:
            text = texts[i].decode()
            each[i] = np.array(slow.encode(text), np.int32)
            counts[i], same[i] = len(each[i]), slow.decode(each[i].tolist()) == text
        ids = np.concatenate(each)
    return ids, counts, same


def encoded(docs: DataFrame, keep: list[str], path: str = MODEL) -> DataFrame:
    """The columns `keep`, ids, how many there are, how many are bytes, and whether they decode to the text.

    The vocabulary comes by broadcast: its size is the file's. A task holds a slice of about SLICE bytes of text, or a single
    longer text, beside its Arrow batch.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(tuple(load(path)))
    kept = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept, strict=True)], F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*vocabulary.value)
        t, slow = _looked_up(v), Coder(v)
        for batch in batches:
            for low, high, data, edges in slices(batch, "text", SLICE):
                ids, counts, same = encode_texts([data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], t, slow)
                filled = np.concatenate([[0], np.cumsum(counts)])
                n_bytes = np.diff(np.concatenate([[0], np.cumsum(t["is_byte"][ids])])[filled])
                lists = pa.ListArray.from_arrays(pa.array(filled, pa.int32()), pa.array(ids, pa.int32()))
                own = batch.slice(low, high - low).select(kept).columns
                yield pa.RecordBatch.from_arrays([*own, pa.array(counts), pa.array(n_bytes, pa.int64()), pa.array(same), lists], [*kept, *COLUMNS])

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in kept)
    out = rows.mapInArrow(run, f"{kinds}, n_pieces bigint, n_byte_pieces bigint, round_trip boolean, ids array<int>")
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)], *COLUMNS)


def decoded(rows: DataFrame, path: str = MODEL) -> DataFrame:
    """rows with the text that column `ids` stands for, as `decoded`."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(tuple(load(path)))

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = Coder(Vocabulary(*vocabulary.value))
        for ids in batches:
            yield pd.Series([None if i is None else coder.decode(list(i)) for i in ids])

    return rows.withColumn("decoded", decode(F.col("ids")))
