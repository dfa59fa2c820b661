"""Language prediction: who is learned from, accuracy on held-out texts, and odd rows."""

import random
import zlib

import numpy as np
import pytest

from shelfline.llm import language

SCHEMA = "doc_id long, text string, lang string, source string, score double"
LETTERS = {"aa": "abcde ", "bb": "fghij ", "cc": "абвгд "}


def text_of(rng, lang, n=300):
    return "".join(rng.choice(LETTERS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(1)
    return [(i, text_of(rng, lang, rng.randint(60, 400)), lang, "s", 9.0) for i in range(240) for lang in [rng.choice(list(LETTERS))]]


def run(spark, docs, parts=3):
    df = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    return {r["doc_id"]: r for r in language.predictions(df, language.Params()).collect()}


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_texts_are_told_apart(spark, docs):
    found = run(spark, docs)
    assert {i for i, r in found.items() if r["held_out"]} == {d[0] for d in docs if is_held_out(d[0])}
    apart = [(found[d[0]]["lang_pred"], d[2]) for d in docs if is_held_out(d[0])]
    assert len(apart) > 50 and np.mean([p == y for p, y in apart]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_partitions_and_row_order_change_nothing(spark, docs):
    one, other = run(spark, docs, 1), run(spark, docs[::-1], 5)
    assert {i: (r["lang_pred"], round(r["score"], 6)) for i, r in one.items()} == {i: (r["lang_pred"], round(r["score"], 6)) for i, r in other.items()}


def test_held_out_labels_and_the_source_teach_nothing(spark, docs):
    # Wrong labels on the held-out rows, and a source that gives the language away.
    spoilt = [(i, t, "zz" if is_held_out(i) else lang, "s" if is_held_out(i) else lang, s) for i, t, lang, _, s in docs]
    found, plain = run(spark, spoilt), run(spark, docs)
    assert {i: r["lang_pred"] for i, r in found.items()} == {i: r["lang_pred"] for i, r in plain.items()}


def test_texts_without_letters_are_undetermined(spark, docs):
    rng = random.Random(2)
    odd = [(1000, None, "aa", "s", 0.0), (1001, "", "aa", "s", 0.0), (1002, "12 34 !?", "bb", "s", 0.0), (1003, text_of(rng, "aa", 200_000), None, "s", 0.0)]
    found = run(spark, docs + odd)
    assert [found[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert found[1003]["lang_pred"] == "aa"


def test_no_rows_and_no_labels(spark):
    assert run(spark, []) == {}
    found = run(spark, [(1, "abc", None, "s", 0.0), (2, None, None, "s", 0.0)])
    assert {r["lang_pred"] for r in found.values()} == {"und"}
