"""The five stages in a row, on the smallest tables."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from shelfline.llm import minhash, quality_rules, secret_ledger, sentencepiece
from tests.conftest import SAMPLE


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    return docs, sentencepiece.decoded(corpus_pipeline.run(spark, SAMPLE)).collect()


def test_every_row_is_a_document_that_the_rules_keep(tables):
    docs, out = tables
    good = {r["doc_id"] for r in quality_rules.verdicts(docs).filter("kept").collect()}
    assert out and {r["doc_id"] for r in out} <= good


def test_one_document_of_each_group_goes_on(spark, tables):
    docs, out = tables
    good = quality_rules.good_documents(docs)
    kept = {r["doc_id"] for r in minhash.one_of_each(good).select("doc_id").collect()}
    assert {r["doc_id"] for r in out} <= kept
    texts = {r["doc_id"]: r["decoded"] for r in out}
    assert len(set(texts.values())) == len(texts)


def test_no_secret_is_left(tables):
    _, out = tables
    for rule in secret_ledger.RULES[: secret_ledger.BASE]:
        pattern = re.compile(rule.pattern)
        for r in out:
            left = [m[0] for m in pattern.finditer(r["decoded"]) if len(m[2]) >= rule.least and "REDACTED" not in m[0]]
            assert not left, (rule.kind, left)


def test_no_document_is_taken_more_than_three_times_and_all_come_back_whole(tables):
    _, out = tables
    assert max(Counter(r["doc_id"] for r in out).values()) <= 3
    assert all(r["round_trip"] and r["n_pieces"] == len(r["ids"]) for r in out)
    assert {r["source"] for r in out} >= {r["source"] for r in out if r["n_pieces"]}
