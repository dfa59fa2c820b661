"""The pipeline's near-duplicate stage decides row by row, whatever ids repeat or lack."""

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, _serial string"


def _text(name, n=60, changed=()):
    return " ".join(f"{name}{k}" if k not in changed else f"other{name}{k}" for k in range(n))


def test_one_row_of_each_group_stays(spark):
    a, b, c, d, e = map(_text, "abcde")
    rows = [
        (1, a), (1, a), (5, a), (None, a),  # repeated, copied, without an id
        (None, b), (None, b), (None, _text("b", changed=(59,))),  # only without ids
        (2, c), (7, c), (7, d),  # 7 repeats: its copy of c goes, d stays
        (8, e), (8, _text("e", changed=(0,))),  # one id, near texts
        (9, None), (9, ""), (9, ""), (None, None),  # nothing to link
    ]
    docs = spark.createDataFrame([(i, t, str(k)) for k, (i, t) in enumerate(rows)], SCHEMA)
    kept = corpus_pipeline.near_dedup(spark, docs, None)
    assert kept.schema == docs.schema
    found = sorted(int(r._serial) for r in kept.collect())
    assert len([k for k in found if k in (0, 1)]) == len([k for k in found if k in (4, 5, 6)]) == len([k for k in found if k in (10, 11)]) == 1
    assert [k for k in found if k not in (0, 1, 4, 5, 6, 10, 11)] == [7, 9, 12, 13, 14, 15]
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), None).count() == 0
