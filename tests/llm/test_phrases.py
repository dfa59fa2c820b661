import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfline.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, n int, a string"


def pieces(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower)]


def brute(docs, support, longest, top):
    out = []
    for lang in {lang or "und" for _, _, lang in docs}:
        f, n = Counter(), 0
        for _, text, own in docs:
            if (own or "und") == lang:
                for words in pieces(text):
                    n += len(words)
                    f.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
        often = {p: c for p, c in f.items() if c >= support}
        rows = []
        for p, a in often.items():
            if len(p) < 2 or any(len(q) > len(p) and often[q] >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q in often):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right, n))
        out += [(lang, rank, p.decode(), -a, left, r, n, -s) for rank, (s, a, p, left, r, n) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeÉfß") for _ in range(rng.randint(1, 5))) for _ in range(40)]
    sets = ["New York City hall", "à la carte", "x y", "x y x y x", "Ibid"]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice(words + sets) + rng.choice([" ", " ", " ", "  ", "\t", ", ", "\n", ".", "! ", " "])
        docs.append((i, text, rng.choice(["en", "de", None])))
    return docs + [(n, None, "en"), (n + 1, "", None), (n + 2, " .,; ", "fr"), (n + 3, "a b " * 3000, "en"), (n + 3, "a b " * 3000, "en")]


def run(spark, docs, **options):
    df = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, t, lang in docs], SCHEMA)
    return sorted(tuple(r) for r in phrases.collocations(df.repartition(5, "doc_id"), **options).collect())


@pytest.mark.parametrize("block,filter_bits", [(1 << 20, 1 << 20), (500, 1 << 20), (3000, 64)])
def test_equals_brute_force(spark, block, filter_bits):
    docs = corpus()
    assert run(spark, docs, support=20, top=50, block=block, filter_bits=filter_bits) == brute(docs, 20, 5, 50)


@pytest.mark.parametrize("parts", [1, 4])
def test_shards_lower_the_support_in_proportion(spark, parts):
    rng = random.Random(2)
    docs = [(i, " ".join(str(rng.randint(0, 30)) for _ in range(400)), "en") for i in range(100)]
    df = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, t, lang in docs], SCHEMA).repartition(parts, "doc_id")
    rows = phrases._rows(df)
    total = rows.selectExpr("sum(octet_length(text))").first()[0]
    found = phrases._mined(rows, {"en": total}, 1000, 5, {"en": total // 4})
    shards = found.filter("phrase is null").collect()
    # Four shards or so: one in four of the occurrences is asked for, and a small rest makes no shard of its own.
    assert 3 <= len(shards) <= 6 and all(120 <= r["below"] + 1 <= 400 for r in shards)
    assert sum(r["below"] + 1 for r in shards) >= 1000 and sum(r["below"] for r in shards) < 1000
    reported = found.filter("phrase is not null").collect()
    assert reported and all(r["times"] > r["below"] for r in reported)


def test_no_phrase_is_lost_that_only_one_shard_has(spark):
    docs = [(i, "red green blue " * 40 if i == 3 else f"w{i} v{i} " * 40, "en") for i in range(12)]
    assert run(spark, docs, support=100, block=600) == brute(docs, 100, 5, 2000)


def test_places_are_within_the_filter():
    key = np.array([2**63, 5], np.uint64)
    assert all(0 <= p < 1000 for place in phrases.bits(key, 1000) for p in place)


def test_empty_table(spark):
    assert run(spark, []) == [] and run(spark, [(1, None, None), (2, "", "en")]) == []


def test_a_long_text(spark):
    rng = random.Random(4)
    docs = [(1, " ".join(rng.choice("abcdefgh") for _ in range(200_000)), "en")]
    assert run(spark, docs, top=30) == brute(docs, 100, 5, 30)


def test_many_shards_store_no_row_for_each_phrase_that_they_have(spark, monkeypatch):
    """With a shard for each text the local support is 1: the shards report every phrase of theirs, but not as rows."""
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["w", "v"]) + str(rng.randint(0, 300)) for _ in range(300)) + " red green blue" * (i % 2), "en") for i in range(200)]
    stored, write = [], phrases.written

    def written(df):
        out = write(df)
        stored.append(out.count())
        return out

    monkeypatch.setattr(phrases, "written", written)
    assert run(spark, docs, support=60, block=1000) == brute(docs, 60, 5, 2000)
    words = sum(len(w) for _, text, _ in docs for w in pieces(text))
    assert sum(stored) < words / 10


def test_second_turn_reports_what_frequent_pairs_make_up(spark):
    docs = [(i, f"red green blue x{i} y{i} z{i}", "en") for i in range(40)]
    rows = phrases._rows(spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, t, lang in docs], SCHEMA))
    sizes, cuts = {"en": 1}, {"en": 4}
    first = phrases._reports(rows, None, 1 << 20, 1, 2, sizes, cuts)
    filter_, words = phrases._together(first, 40, 1 << 20, 3)
    assert words == {"en": 240} and first.filter("part >= 0").agg({"n": "sum"}).first()[0] == 40 * (6 + 5)
    second = phrases._reports(rows, spark.sparkContext.broadcast(filter_), 1 << 20, 3, 5, sizes, cuts)
    assert second.agg({"n": "sum"}).first()[0] == 40  # "red green blue" of each text


@pytest.mark.parametrize("n", [1, 2, 1000])
def test_reports_are_read_as_written(n):
    rng = np.random.default_rng(n)
    prefix = np.unique(rng.integers(0, 1 << phrases.PREFIX, n, dtype=np.uint64))
    times = rng.integers(1, 1 << 30, len(prefix))
    both = phrases.unpacked(phrases.packed(prefix, times), len(prefix))
    most = (1 << phrases.TIMES) - 1
    assert (both >> np.uint64(phrases.TIMES) == prefix).all() and ((both & np.uint64(most)).astype(np.int64) == np.minimum(times, most)).all()


def test_occurrences_are_added_up_and_stopped_ones_pass():
    def report(of):
        return phrases.unpacked(phrases.packed(np.array(sorted(of), np.uint64), np.array([of[k] for k in sorted(of)])), len(of))

    found = [report({3: 5, 7: 2}), report({3: 5, 9: 1 << 26}), report({7: 7})]
    assert phrases._reached(found, 10).tolist() == [3, 9] and phrases._reached(found, 1 << 25).tolist() == [9]


def test_filter_of_no_hashes_is_empty():
    word, bit = phrases._set(np.empty(0, np.uint64), 1 << 10)
    assert len(word) == 0 and len(bit) == 0
