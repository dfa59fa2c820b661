import hashlib
import math

import numpy as np
import pytest

from shelfline.llm import codebooks

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, of string"


def brute(rows, parts=8, entries=16, rounds=6):
    """By full searches, in Python's whole numbers."""
    kept = [(i, [math.floor(4096 * x) for x in e], label) for i, e, label in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, [x for x in r[1]]))
    width = len(order[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in order[:entries]] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        at = [[nearest(v, p)[1] for p in range(parts)] for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), a in zip(kept, at, strict=True) if a[p] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [(i, label, [nearest(v, p) for p in range(parts)]) for i, v, label in kept]
    of_label = {}
    for _, label, near in found:
        of_label[label] = of_label.get(label, 0) + sum(d for d, _ in near)
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(
        (str(i), "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), of_label[label], digest) for i, label, near in found
    )


def rows_of(seed, n, width=16, close=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, width))
    vectors = (centres[rng.integers(0, 9, n)] + close * rng.normal(size=(n, width))).astype(np.float32)
    return [(i, [float(x) for x in v], [None, 0, 1][i % 3]) for i, v in enumerate(vectors)]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    return sorted((str(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in codebooks.codes(df).collect())


@pytest.mark.parametrize("seed,n,close", [(1, 400, 0.05), (2, 300, 1.0)])
def test_equals_full_searches(spark, seed, n, close):
    rows = rows_of(seed, n, close=close)
    assert run(spark, rows) == brute(rows)


def test_vectors_that_are_not_whole_are_dropped(spark):
    rows = rows_of(3, 60)
    bad = [(900, None, 1), (901, [*rows[0][1][:-1], None], 1), (902, [math.nan, *rows[0][1][1:]], 1), (903, [math.inf, *rows[0][1][1:]], None)]
    assert run(spark, rows + bad) == brute(rows)


def test_ties_repeated_rows_and_null_ids(spark):
    flat = [(i // 2, [float(i % 4)] * 16, None) for i in range(40)] + [(None, [2.0] * 16, 5)] * 3
    assert run(spark, flat) == brute(flat)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_fewer_rows_than_entries(spark, n):
    rows = rows_of(4, n)
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_no_held_vector(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, 1), (2, [math.nan] * 16, 1)]) == []


def test_unlike_lengths_raise(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, [0.5] * 16, 1), (2, [0.5] * 8, 1)])


def test_bounds_spare_searches_and_adapt(spark):
    book = codebooks.fitted(spark.createDataFrame([(*r, "x", 1, "y") for r in rows_of(5, 400)], SCHEMA))
    assert len(book.sizes) == 7 and any(size != book.sizes[0] for size in book.sizes)
    # Of the parts in the last round, most kept their entry without any comparison with a listed one.
    needs = [n for r in book.state.select("need").collect() for n in r["need"]]
    assert sum(n == 0 for n in needs) > len(needs) / 2


def test_decoded_vectors_have_the_errors_that_codes_tell(spark):
    rows = rows_of(6, 100)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    book = codebooks.fitted(df)
    back = {r["vec_id"]: r for r in codebooks.decoded(codebooks.codes(df), book.books).collect()}
    for i, v, _ in rows:
        whole = [math.floor(4096 * x) for x in v]
        assert sum((a - round(4096 * b)) ** 2 for a, b in zip(whole, back[i]["vector"], strict=True)) == back[i]["error"]
