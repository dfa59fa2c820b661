"""Quality rules on texts whose shares have nothing to divide by, and their counts against plain Python."""

import re

import corpus_pipeline
from shelfline.llm import quality_rules

SCHEMA = "doc_id bigint, text string, n_words string"
PROSE = " ".join(f"the {a}{b}lo of {b}{a}mi and" for a in "abcdefg" for b in "uvwxyz")
NOTHING = [None, "", " \t\n ", "12 34", " ".join(str(k) for k in range(60)), "\n\n"]


def _docs(spark, texts):
    return spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], SCHEMA)


def test_texts_without_words_or_letters_are_judged(spark):
    found = {r.doc_id: r for r in quality_rules.verdicts(_docs(spark, [*NOTHING, PROSE])).collect()}
    assert len(found) == len(NOTHING) + 1
    assert [found[k].n_words for k in range(len(NOTHING))] == [0, 0, 0, 2, 60, 0]
    assert [found[k].base_failed for k in range(len(NOTHING))] == [True, True, True, True, False, True]
    assert not any(found[k].kept for k in (0, 1, 2, 3, 5))
    assert found[len(NOTHING)].kept


def test_rules_abstain_without_a_denominator(spark):
    votes = {r.doc_id: dict(zip([rule.name for rule in quality_rules.RULES], r.votes, strict=True))
             for r in quality_rules.measured(_docs(spark, NOTHING), ["doc_id"]).select("_row.doc_id", "_q.votes").collect()}
    for k in (0, 1, 2, 5):
        assert votes[k] == {rule.name: -1 if rule.name == "length" else 0 for rule in quality_rules.RULES}
    assert votes[4]["capitals"] == 0 and votes[4]["letters"] == -1


def test_pipeline_stage_passes_over_texts_without_words(spark):
    docs = _docs(spark, [*NOTHING, PROSE, PROSE])
    kept = corpus_pipeline.quality(spark, docs, None)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect()} >= {len(NOTHING), len(NOTHING) + 1}
    assert not {r.doc_id for r in kept.collect()} & {0, 1, 2, 3, 5}
    assert corpus_pipeline.quality(spark, spark.createDataFrame([], docs.schema), None).count() == 0


def test_counts_equal_plain_python(spark):
    texts = [PROSE, "A # b\nA # b\n\nC", "one two three one two three one", "Été ÀB 12", *NOTHING]
    rows = quality_rules.measured(_docs(spark, texts), ["doc_id"]).select("_row.doc_id", "_q.*").collect()
    for row in rows:
        text = texts[row.doc_id] or ""
        words, lines = re.findall(r"[^ \t-\r]+", text), [x for x in text.split("\n") if re.sub(r"[ \t-\r]", "", x)]
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
        letters = [c for c in text if c.isalpha()]
        expected = (len(words), sum(map(len, words)), sum(c in quality_rules.SYMBOLS for c in text), len(lines),
                    len(lines) - len(set(lines)), len(letters), sum(c.isupper() for c in letters),
                    sum(w.lower() in quality_rules.COMMON_WORDS for w in words), len(covered))
        assert tuple(row[m] for m in quality_rules.MEASURES) == expected
