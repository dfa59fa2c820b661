"""The mix against its SQL and its targets where ids lack or repeat."""

from collections import Counter, defaultdict

import duckdb

import corpus_pipeline
from shelfline.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string"
WORDS = "one two three four five six seven eight nine ten"


def _docs(spark):
    rows = [(None, WORDS, "a") for _ in range(40)] + [(3, WORDS, "b") for _ in range(30)]
    rows += [(k, WORDS + " 1" * (k % 7), "c") for k in range(100, 140)] + [(None, WORDS, None) for _ in range(35)] + [(1, None, "a"), (None, "", "b")]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)


def test_rows_without_ids_are_taken_one_by_one(spark, tmp_path):
    rows, docs = _docs(spark)
    docs.write.parquet(str(tmp_path / "docs"))
    found = mixing.shares(spark.read.parquet(str(tmp_path / "docs"))).collect()
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/docs/*.parquet'")
    expected = duck.execute(mixing.oracle()).fetchall()

    def counts(rows):
        return Counter((r[0], r[1], r[2], round(r[3], 6), r[4]) for r in rows)

    assert len(found) == len(rows) and counts(found) == counts(expected)


def test_each_source_meets_its_target(spark):
    rows, docs = _docs(spark)
    goal = {(r.source_size, round(r.target, 6)) for r in mixing.shares(docs).collect()}
    mixed = corpus_pipeline.mix(spark, docs, None)
    assert mixed.schema == docs.schema
    words, own = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    for _, text, source in rows:
        own[source] += len((text or "").split())
    left = [target for size, target in sorted(goal)]
    assert sorted(own.values()) == [size for size, _ in sorted(goal)]
    for source, target in zip(sorted(own, key=own.get), left, strict=True):
        assert abs(words[source] - target) <= 8
    assert corpus_pipeline.mix(spark, docs.limit(0), None).count() == 0
