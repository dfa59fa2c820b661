import hashlib
import random

import pytest

from shelfline.llm import debruijn
from shelfline.llm.places import numbered

SCHEMA = "doc_id long, text string, h string, start int, n int, fp1 string"


def brute(docs, window):
    """By a set of all earlier windows, document by document."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[doc_id] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in docs], SCHEMA)
    return debruijn.removed(df, **options)


def corpus():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, line = prose(60), prose(22)
    docs = [(0, None), (1, ""), (2, " \t\n "), (3, "a " * 300), (4, "a b " * 80), (5, "a " * 25), (6, shared), (7, shared), (8, prose(4000)), (9, shared.replace(" ", "\r\n\x0b\x0c"))]
    # Copies that begin and end within the passage, with other words around, and branches within it.
    docs += [(10 + i, f"{prose(i)} {' '.join(shared.split()[i * 2 :])} {prose(5)}") for i in range(20)]
    docs += [(40 + i, " ".join(f"{prose(i % 7)} {line}" for _ in range(3))) for i in range(15)]
    docs += [(60 + i, " ".join(w if k % 30 else prose(1) for k, w in enumerate(docs[8][1].split()[i * 50 : i * 50 + 200]))) for i in range(15)]
    docs += [(80, docs[8][1]), (81, docs[8][1] + " " + docs[8][1]), (82, " ".join(shared.split()[:19])), (83, " ".join(shared.split()[:20]))]
    return docs


@pytest.mark.parametrize("window,gram", [(20, 6), (20, 20), (5, 2)])
def test_equals_brute_force(spark, window, gram):
    docs = corpus()
    got = {r["doc_id"]: tuple(r)[1:4] for r in run(spark, docs, window=window, gram=gram).collect()}
    assert got == brute(docs, window)


def test_paths_are_whole_and_branch_nowhere(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join(str(rng.random()) for _ in range(n))
    passage = prose(500)
    docs = [(i, f"{prose(30)} {passage} {prose(30)}") for i in range(6)]
    docs += [(9, f"{prose(30)} {' '.join(passage.split()[100:])}")]
    df = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in docs], SCHEMA)
    edges = debruijn.repeated_edges(numbered(df, debruijn.BITS), 20, 6)
    found = sorted((*divmod(r["head"], 1 << debruijn.BITS), r["windows"]) for r in debruijn.paths(edges).collect())
    # One text enters the passage at its 100th word, so it is two paths there.
    assert found == [(0, 30, 100), (0, 130, 381)]


def test_a_hot_passage_makes_no_pairs(spark):
    passage = " ".join(map(str, range(30)))
    docs = [(i, f"w{i} {passage} v{i}") for i in range(3000)]
    df = spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in docs], SCHEMA)
    edges = debruijn.repeated_edges(numbered(df, debruijn.BITS), 20, 6)
    assert edges.agg({"n": "sum"}).first()[0] == 3000 * 11
    got = {r["doc_id"]: r["n_removed"] for r in debruijn.removed(df).collect()}
    assert got == {i: 30 if i else 0 for i in range(3000)}


def test_ids_that_are_no_numbers(spark):
    text = " ".join(map(str, range(50)))
    df = spark.createDataFrame([("b", text), ("a", "x " + text), ("c", text)], "doc_id string, text string")
    assert {r["doc_id"]: r["n_removed"] for r in debruijn.removed(df).collect()} == {"a": 0, "b": 50, "c": 50}


def test_empty_table(spark):
    assert run(spark, []).count() == 0


def test_a_long_text(spark):
    text = " ".join(str(i * 7919 % 100003) for i in range(300_000))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in run(spark, [(1, text), (2, "x " + text)]).collect()}
    assert got == {d: (v[0], v[1]) for d, v in brute([(1, text), (2, "x " + text)], 20).items()}


def test_rows_that_repeat_an_id(spark):
    text = " ".join(map(str, range(100)))
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in run(spark, [(1, text), (1, text), (2, text), (None, text), (None, "a b")]).collect())
    assert got == [(0, 0), (0, 0), (1, 100), (1, 100), (2, 100)]
