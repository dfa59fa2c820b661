"""Words of many texts at once, as arrays: where they are, and hashes of them and of runs of them.

Texts are taken as UTF-8 from Arrow batches. What the hashing holds is bounded by `BYTES` beside an array or two of a
number for each word, so a long text costs its own size, not a multiple of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of texts that are worked on together, if they are not of one text.
BYTES = 1 << 20
#: The bytes between words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def _drawn(seed: int, n: int) -> np.ndarray:
    """n odd numbers; the first ones are the same for every n."""
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


def flags(values: bytes) -> np.ndarray:
    """For each byte whether it is one of `values`."""
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def slices(batch: pa.RecordBatch, column: str = "text", size: int = BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind, bytes, edges): rows of about `size` bytes of text, whose bytes lie between their edges. No nulls."""
    texts = batch[column]
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def spans(data: np.ndarray, edges: np.ndarray, between: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each maximal run of bytes that are not `between`, in one text: its start, its end and its text's number."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~between[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[edges] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (cut | ~before))
    ends = np.flatnonzero(before & (cut | ~inside))
    return starts, ends, np.searchsorted(edges, starts, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    lengths = ends - starts
    filled = np.concatenate([[0], np.cumsum(lengths)])
    table, out, low = _drawn(seed, 256), np.empty(len(starts), np.uint64), 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(filled, filled[low] + BYTES, "right")) - 1)
        n = lengths[low:high]
        place = np.arange(filled[high] - filled[low]) - np.repeat(filled[low:high] - filled[low], n)
        weight = _drawn(seed + 1, 1 << max(10, int(n.max() - 1).bit_length()))
        terms = table[data[np.repeat(starts[low:high], n) + place]] * weight[place]
        out[low:high] = np.add.reduceat(terms, filled[low:high] - filled[low])
        low = high
    return mixed(out)


def runs(of: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k neighbours, from those of parts whose lengths are powers of two."""
    total, done, span, power = None, 0, 1, of
    while True:
        if k & span:
            if total is None:
                total = power
            else:
                n = max(len(total) - span, 0)
                total = mixed(total[:n] * _ODD + power[done : done + n])
            done += span
        if 2 * span > k:
            return total[: max(len(of) - k + 1, 0)]
        power = mixed(power[: max(len(power) - span, 0)] * _ODD + power[span:])
        span *= 2
