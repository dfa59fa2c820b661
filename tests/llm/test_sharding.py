"""The written folder keeps what the shards report, also where rows and ids repeat."""

from collections import Counter, defaultdict

from pyspark.sql import functions as F

from shelfline.llm import sharding

SCHEMA = "doc_id bigint, text string, depth string"


def test_written_shards_are_within_the_limit(spark, tmp_path):
    rows = [(1, "x" * 100, "r")] * 9 + [(2, f"{k:0100d}", "i") for k in range(9)] + [(None, f"{k:0100d}", "n") for k in range(9)]
    rows += [(k, "y" * (k % 50), "u") for k in range(10, 60)] + [(70, "z" * 900, "l"), (71, None, "e"), (71, None, "e")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    sharding.write(docs, str(tmp_path / "out"), 250)
    out = spark.read.schema(SCHEMA + ", shard string").parquet(str(tmp_path / "out"))
    found = out.collect()
    assert Counter((r.doc_id, r.text, r.depth) for r in found) == Counter(rows)
    held = defaultdict(list)
    for r in found:
        held[r.shard].append(len(r.text or ""))
    assert all(sum(sizes) <= 250 or len(sizes) == 1 for sizes in held.values())
    reported = sharding.shards(docs, 250).select(F.col("shard"), "shard_bytes", "shard_docs").distinct().collect()
    assert {s: (sum(x), len(x)) for s, x in held.items()} == {r.shard: (r.shard_bytes, r.shard_docs) for r in reported}
