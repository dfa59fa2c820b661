import random
import re

from shelfline.llm import blocks, minhash

SCHEMA = "doc_id long, text string, band string, n int"


def shingles(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[k : k + size]) for k in range(max(len(words) - size + 1, 1))}


def expected(texts, percent=85):
    sets, least = [shingles(t) for t in texts], list(range(len(texts)))

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    for b in range(len(sets)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return sets, [root(k) for k in range(len(texts))]


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SIZE", 8)  # hot bands go through many blocks
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts = [" ".join(base), " ".join(base).upper(), None, "", " \n", "one", "One two", "one two"]
    for k in range(90):  # a group around one text, many members of which are too far from it
        words = list(base)
        for _ in range(k % 9):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"v{rng.randrange(300)}" for _ in range(60)) for _ in range(30)]
    df = spark.createDataFrame([(k, t, "x", None) for k, t in enumerate(texts)] + [(None, texts[0], None, 1)], SCHEMA)
    rows = {r["doc_id"]: r for r in minhash.groups(df, minhash.CONTRACT).collect()}
    sets, least = expected(texts)
    for k in range(len(texts)):
        assert (rows[k]["n_shingles"], rows[k]["component_id"], rows[k]["kept"]) == (len(sets[k]), least[k], least[k] == k)
    assert rows[None]["component_id"] is None and rows[None]["kept"]


def test_empty_table(spark):
    assert minhash.groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_members_of_a_crowded_bucket_travel_in_step_with_their_number(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SIZE", 8)
    made, in_groups = [], blocks.in_groups
    monkeypatch.setattr(blocks, "in_groups", lambda rows, *more: made.append(rows.count()) or in_groups(rows, *more))

    def rows_made(n):
        rng = random.Random(5)
        base = [f"w{k}" for k in range(200)]
        texts = []
        for k in range(n):  # pairs lie just below the threshold
            words = list(base)
            for _ in range(6):
                words[rng.randrange(len(words))] = f"x{k}_{rng.randrange(10**6)}"
            texts.append(" ".join(words))
        df = spark.createDataFrame([(k, t, "x", None) for k, t in enumerate(texts)], SCHEMA)
        made.clear()
        found = {r["doc_id"]: r["component_id"] for r in minhash.groups(df, minhash.CONTRACT).collect()}
        assert [found[k] for k in range(n)] == expected(texts)[1]
        return sum(made)

    few, many = rows_made(40), rows_made(80)
    print("rows", few, many)
    assert many <= 3 * few
