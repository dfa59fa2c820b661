import hashlib
import random

import numpy as np
import pytest

from shelfline.llm import suffixes
from shelfline.llm.places import numbered

SCHEMA = "doc_id long, text string, h string, start int"


def brute(docs, length):
    """By a set of all earlier strings, document by document."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            if data[s : s + length] in seen:
                gone[s : s + length] = [True] * length
            seen.add(data[s : s + length])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, line = prose(40), prose(9)
    docs = [(0, None), (1, ""), (2, "a" * 400), (3, "ab" * 150), (4, "a" * 120), (5, shared), (6, shared), (7, prose(3000))]
    docs += [(10 + i, f"{prose(i)} {shared[i:]} {prose(5)}") for i in range(15)]
    docs += [(40 + i, " ".join(f"{prose(6)} {line}" for _ in range(4))) for i in range(20)]
    docs += [(70, docs[7][1][500:900] + prose(20) + docs[7][1][300:700]), (71, shared[:99]), (72, shared[:100])]
    return docs


@pytest.mark.parametrize("batches", [1, 4, 5])
def test_equals_brute_force(spark, batches):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], SCHEMA)
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffixes.removed(df, batches).collect()}
    assert got == brute(docs, suffixes.LENGTH)


def test_empty_table(spark):
    assert suffixes.removed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_that_repeat_an_id_and_text_are_one_document(spark):
    text = " ".join(map(str, range(100)))
    df = spark.createDataFrame([(1, text, "", 0), (1, text, "", 0), (2, text, "", 0)], SCHEMA)
    got = sorted((r["doc_id"], r["n_removed"]) for r in suffixes.removed(df).collect())
    assert got == [(1, 0), (1, 0), (2, len(text))]


def test_the_query_merges_levels_without_shuffles(spark):
    docs = [(i, t, "x", 1) for i, t in corpus()]
    family = suffixes.indexed(numbered(spark.createDataFrame(docs, SCHEMA), suffixes.BITS))
    assert suffixes.BATCHES == 4 and family.merges == 3 and [n for n, _ in family.levels] == [4]
    level = family.levels[0][1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = level.join(level.select(*suffixes.ENTRY, "n"), suffixes.ENTRY)
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_text(spark):
    text = " ".join(str(i * 7919 % 1000003) for i in range(300_000))
    df = spark.createDataFrame([(1, text, "", 0), (2, "x" + text, "", 0)], SCHEMA)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in suffixes.removed(df).collect()}
    assert got == {1: (len(text), 0), 2: (len(text) + 1, len(text))}


def test_repeated_rows_with_passages_that_blocks_share_in_part(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join(str(rng.random()) for _ in range(n))
    shared = prose(20)
    one, two = f"{prose(9)} {shared} {prose(9)}", f"{prose(7)} {shared} {prose(11)}"
    df = spark.createDataFrame([(1, one, "", 0), (1, one, "", 0), (2, two, "", 0)], SCHEMA)
    got = sorted({(r["doc_id"], r["n_removed"]) for r in suffixes.removed(df).collect()})
    want = brute([(1, one), (2, two)], 100)
    assert got == [(1, 0), (2, want[2][1])] and want[2][1] >= len(shared)


def test_blocks_hash_texts_for_their_grams_only(monkeypatch):
    lengths, hashes = [], suffixes.string_hashes
    monkeypatch.setattr(suffixes, "string_hashes", lambda data, length, seed: lengths.append(length) or hashes(data, length, seed))
    data = np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8)
    text, gram, fp, start, n = suffixes.blocks(np.concatenate([data, data]), np.array([0, 5000, 10000]), 100, 32)
    assert lengths == [32]
    same = [np.stack([gram, fp, start, n])[:, text == k].tolist() for k in (0, 1)]
    assert same[0] == same[1] and sum(same[0][3]) == 4901 and len(set(same[0][1])) == len(same[0][1])


def test_strings_of_blocks_are_hashed_by_themselves(monkeypatch):
    monkeypatch.setattr(suffixes, "SLICE", 1000)
    sizes, hashes = [], suffixes.string_hashes
    monkeypatch.setattr(suffixes, "string_hashes", lambda data, length, seed: sizes.append(len(data)) or hashes(data, length, seed))
    data = np.random.default_rng(2).integers(0, 4, 100_000, dtype=np.uint8)
    starts, ns = np.array([7, 50_000, 90, 99_900]), np.array([60, 1, 2000, 1])
    found = suffixes._hashed(data, starts, ns, 100)
    assert sum(sizes) == 2 * sum(n + 99 for n in ns)
    at = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, ns)])
    for got, seed in zip(found, (2, 3)):
        assert (got == hashes(data, 100, seed)[at]).all()


def test_merges_that_follow_each_other_are_written_once(spark, monkeypatch):
    stored, bucketed = [], suffixes.bucketed
    monkeypatch.setattr(suffixes, "bucketed", lambda df, *more: stored.append(df.columns) or bucketed(df, *more))
    docs = [(i, t, "x", 1) for i, t in corpus()]
    family = suffixes.indexed(numbered(spark.createDataFrame(docs, SCHEMA), suffixes.BITS))
    # Four arrays, what three of them share with levels, the third array's rest, and two merges.
    assert len(stored) == 10 and family.merges == 3
