"""Viterbi against every segmentation of short texts, and the pipeline's last stage."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from shelfline.llm import sentencepiece as sp

TEXTS = ["the cat", "unbelievable", "a  b", " x", "naïve 東", "▁a", "\U0001f600!"]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load()


def _best(run, scores, unknown):
    """The greatest sum of log scores over all segmentations into pieces and single unknown characters."""
    if not run:
        return 0.0
    found = -math.inf
    for n in range(1, len(run) + 1):
        score = scores.get(run[:n], unknown if n == 1 else None)
        if score is not None:
            found = max(found, score + _best(run[n:], scores, unknown))
    return found


def test_paths_are_the_best_of_all(vocabulary):
    coder = sp.Coder(vocabulary)
    scores = {p: vocabulary.scores[i] for i, p in enumerate(vocabulary.pieces) if p is not None}
    for run in ("▁cat", "▁unbeliev", "▁▁b", "▁na", "▁x東"):
        ids, total = coder.best(run), 0.0
        at = 0
        while at < len(ids):
            piece = vocabulary.pieces[ids[at]]
            if piece is None:
                first = coder.of_byte[ids[at]]
                at, total = at + (1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4), total + coder.unknown
            else:
                at, total = at + 1, total + scores[piece]
        assert math.isclose(total, _best(run, scores, coder.unknown), rel_tol=1e-9)


def test_every_text_comes_back(spark, vocabulary):
    rows = [(k, t, "s") for k, t in enumerate([*TEXTS, TEXTS[0], None, ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r for r in sp.decoded(corpus_pipeline.encode(spark, docs, None)).collect()}
    assert len(found) == len(rows)
    for k, text, _ in rows:
        assert found[k].decoded == (text or "") and found[k].round_trip and found[k].n_pieces == len(found[k].ids)


def test_side_by_side_gives_the_ids_of_one_by_one(vocabulary):
    rng = random.Random(1)
    chars = "aeinorst .,\n\t  é東▁😀\x00Zq"
    texts = [*TEXTS, "", " ", "   x  ", "z" * 1000, "thequickbrownfox" * 20, *["".join(rng.choice(chars) for _ in range(rng.randint(1, 80))) for _ in range(400)]]
    coder = sp.Coder(vocabulary)
    ids, counts, same = sp.encode_texts([t.encode() for t in texts], sp._looked_up(vocabulary), coder)
    at = np.concatenate([[0], np.cumsum(counts)])
    assert same.all()
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [coder.encode(t) for t in texts]


def test_the_trie_finds_all_pieces_and_nothing_else(vocabulary):
    base, check, value = vocabulary.base, vocabulary.check, vocabulary.value

    def found(key):
        state = 0
        for c in key:
            child = base[state] + c + 1
            if child >= len(check) or check[child] != state:
                return -1
            state = child
        return value[state]

    pieces = {p.encode(): i for i, p in enumerate(vocabulary.pieces) if p is not None}
    assert all(found(k) == i for k, i in pieces.items())
    assert all(found(k + b"\x00") == pieces.get(k + b"\x00", -1) for k in pieces)


def test_empty_table_clashing_names_and_long_text(spark):
    schema = "doc_id bigint, text string, source string, ids string, n_pieces int, round_trip int, _k0 int"
    assert corpus_pipeline.encode(spark, spark.createDataFrame([], schema), None).count() == 0
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(350_000))
    assert len(long) > 2_000_000
    rows = [(1, long, "s", "x", 1, 1, 1), (2, "x" * 100_000, "s", "x", 1, 1, 1), (3, "short", "s", "x", 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    found = sp.encoded(docs, ["doc_id", "_k0"])
    assert found.columns == ["doc_id", "_k0", *sp.COLUMNS]
    back = {r.doc_id: r for r in sp.decoded(found).collect()}
    assert all(back[r[0]].decoded == r[1] and back[r[0]].round_trip for r in rows)

