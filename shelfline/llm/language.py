"""Language of a text by a byte convolutional network, trained here in numpy.

A text's UTF-8 bytes are cut into windows of fixed length, the last filled up with zeros. In a
window each filter (of widths 2 to 4 bytes) is slid over one learned vector per byte; its greatest
response, through a softmax over the languages, gives the window's prediction. A text's score of a
language is the mean over all its windows, weighted by their bytes.

Training takes at most `per_lang` documents of each language (those with the smallest hashes of
their id, so reruns agree) and `per_doc` windows of each; these bounds are what the driver holds.

Texts that are null or hold no letter are `und` with score 0, and are never learned from, nor are
rows without lang or doc_id. With nothing to learn from, every text is `und`. Rows without a
doc_id are held out. Repeated rows are predicted alike. An empty table gives an empty result.
Columns other than doc_id, text and lang are not read, and lang only to train.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """filters: of each width. block: windows that go through the network at once."""

    window: int = 192
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    embedding: int = 8
    per_lang: int = 300
    per_doc: int = 3
    epochs: int = 12
    batch: int = 64
    rate: float = 0.01
    block: int = 128
    seed: int = 3


@dataclass
class Network:
    """embed: a vector for each byte. kernels: per width (width, embedding, filters). out: filters to languages."""

    languages: list[str]
    embed: np.ndarray
    kernels: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray


def windows(text: str, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the text, and how many bytes of each are text."""
    data = np.frombuffer(text.encode(errors="replace"), np.uint8)
    n = -(-len(data) // length)
    x = np.zeros(n * length, np.uint8)
    x[: len(data)] = data
    used = np.full(n, length)
    if n:
        used[-1] = len(data) - (n - 1) * length
    return x.reshape(n, length), used


def _responses(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(windows, places, filters): for each place the sum over the width of what the bytes there add."""
    width = len(tables)
    places = x.shape[1] - width + 1
    total = tables[0][x[:, :places]]
    for k in range(1, width):
        total += tables[k][x[:, k : k + places]]
    return total


def tables(net: Network) -> list[np.ndarray]:
    """Per width: what each byte adds to each filter at each place of the filter."""
    return [np.ascontiguousarray(net.embed @ kernel) for kernel in net.kernels]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(net: Network, of: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    pooled = np.concatenate([np.maximum(_responses(x, t).max(axis=1), 0) for t in of], axis=1)
    return softmax(pooled @ net.out + net.bias)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], p: Params) -> Network:
    """By Adam on the cross-entropy. Gradients reach a filter through its greatest response only."""
    rng = np.random.default_rng(p.seed)
    n_lang, n_filters = len(languages), p.filters * len(p.widths)

    def start(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    embed = start(256, p.embedding, scale=1.0)
    kernels = [start(w, p.embedding, p.filters, scale=(w * p.embedding) ** -0.5) for w in p.widths]
    out, bias = start(n_filters, n_lang, scale=n_filters**-0.5), np.zeros(n_lang, np.float32)
    weights = [embed, out, bias, *kernels]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    net = Network(languages, embed, kernels, out, bias)
    for _ in range(p.epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), p.batch):
            xs, ys = x[order[at : at + p.batch]], y[order[at : at + p.batch]]
            rows, columns = np.arange(len(xs)), np.arange(p.filters)
            best, pooled = [], []
            for t in tables(net):
                r = _responses(xs, t)
                best.append(r.argmax(axis=1))
                pooled.append(np.maximum(r[rows[:, None], best[-1], columns], 0))
            h = np.concatenate(pooled, axis=1)
            d = softmax(h @ out + bias)
            d[rows, ys] -= 1
            d /= len(xs)
            dh = np.split((d @ out.T) * (h > 0), len(p.widths), axis=1)
            grads = [np.zeros_like(embed), h.T @ d, d.sum(axis=0)]
            for kernel, where, g in zip(kernels, best, dh, strict=True):
                dk = np.zeros_like(kernel)
                for k in range(len(kernel)):
                    seen = xs[rows[:, None], where + k]
                    dk[k] = np.einsum("bfe,bf->ef", embed[seen], g)
                    np.add.at(grads[0], seen, g[..., None] * kernel[k].T)
                grads.append(dk)
            step += 1
            for w, g, a, b in zip(weights, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= p.rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3


def held_out() -> Column:
    return F.coalesce(_remainder() == 1, F.lit(True))


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def sample(docs: DataFrame, p: Params) -> list[tuple[str, str]]:
    """(lang, text cut-outs) of at most per_lang documents of each language, none of them held out.

    The smallest hashes are found by partial aggregates of bounded size; only the chosen texts travel.
    """
    rows = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & ~held_out() & has_letter())
    rows = rows.withColumn("h", F.xxhash64(F.lit(p.seed), "doc_id"))
    # Per part, then over the parts: at most per_lang hashes of each language leave a part.
    part = W.partitionBy("lang", "part").orderBy("h")
    few = rows.select("lang", "h", (F.col("h") % 64).alias("part")).distinct()
    few = few.withColumn("k", F.row_number().over(part)).filter(F.col("k") <= p.per_lang).drop("k", "part")
    few = few.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= p.per_lang)
    few = few.groupBy("lang").agg(F.max("h").alias("last"))
    n = p.window
    # Windows spread evenly over the whole text; characters are never more than their bytes.
    starts = [F.floor((F.length("text") - n) * (k / max(p.per_doc - 1, 1))) for k in range(p.per_doc)]
    cuts = F.array(*[F.substring("text", F.greatest(F.lit(0), s).cast("int") + 1, F.lit(n)) for s in starts])
    chosen = rows.join(few, "lang").filter(F.col("h") <= F.col("last")).dropDuplicates(["lang", "h"])
    chosen = chosen.select("lang", "h", F.array_distinct(cuts).alias("cuts")).orderBy("lang", "h")
    return [(r["lang"], cut) for r in chosen.collect() for cut in r["cuts"]]


def fitted(docs: DataFrame, p: Params = Params()) -> Network | None:
    found = sample(docs, p)
    if not found:
        return None
    languages = sorted({lang for lang, _ in found})
    x = np.concatenate([windows(text, p.window)[0][:1] for _, text in found])
    return train(x, np.array([languages.index(lang) for lang, _ in found]), languages, p)


def _predictor(net: Network, p: Params):
    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = tables(net)
        for texts in batches:
            out = []
            for text in texts:
                x, used = windows(text or "", p.window)
                total = np.zeros(len(net.languages))
                for at in range(0, len(x), p.block):
                    total += used[at : at + p.block] @ predict(net, of, x[at : at + p.block])
                best = int(total.argmax())
                out.append((net.languages[best], min(float(total[best] / max(used.sum(), 1)), 1.0)))
            yield pd.DataFrame(out, columns=["lang", "score"])

    return predicted


def predictions(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score."""
    net = fitted(docs, p)
    rows = docs.select("doc_id", "text")
    if net is None:
        return rows.select("doc_id", held_out().alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    out = rows.select("doc_id", held_out().alias("held_out"), has_letter().alias("some"), _predictor(net, p)("text").alias("p"))
    return out.select(
        "doc_id", "held_out", F.when(F.col("some"), F.col("p.lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("some"), F.col("p.score")).otherwise(0.0).alias("score"))
