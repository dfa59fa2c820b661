"""Comparing members of groups with each other in blocks of bounded size, without a row for each pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 256


def chunks(n: str | Column, size: int | None = None) -> Column:
    """Into how many chunks (of `SIZE`, or of another size) n members go."""
    return F.ceil((F.col(n) if isinstance(n, str) else n) / (size or SIZE)).cast("int")


def chunk(member: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(member), count).cast("int")


def in_groups(rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What `work` makes of the rows of each group of equal (non-null) keys; memory is that of an Arrow batch and a group."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            of = batch[keys].to_numpy()
            starts = np.flatnonzero(np.append(True, (of[1:] != of[:-1]).any(axis=1)))
            found = [work(batch.iloc[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            rest = batch.iloc[starts[-1] :]
            if found:
                yield pd.concat(found, ignore_index=True)
        if rest is not None:
            yield work(rest)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places of both ends) that join what a symmetric matrix joins: fewer than it has rows."""
    seen, ends = np.zeros(len(linked), bool), ([], [])
    for start in np.flatnonzero(linked.any(axis=1)):
        if seen[start]:
            continue
        seen[start], front = True, np.array([start])
        while len(front):
            reached = linked[front] & ~seen
            to = np.flatnonzero(reached.any(axis=0))
            ends[0].append(front[reached[:, to].argmax(axis=0)])
            ends[1].append(to)
            seen[to], front = True, to
    none = np.empty(0, np.int64)
    return (np.concatenate([none, *ends[0]]), np.concatenate([none, *ends[1]]))


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many elements each set of `left` shares with each of `right`: products of 0/1 matrices, some columns at a time."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    out = np.zeros((len(left), len(right)))
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        a, b = np.searchsorted(at, [low, low + columns])
        part = np.zeros((len(sets), columns), np.float32)
        part[row[a:b], at[a:b] - low] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out
