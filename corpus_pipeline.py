"""From raw documents to token ids: five stages, each a function (spark, docs, sf_dir) -> DataFrame.

Every stage works on all rows that its predecessor wrote. All but the last return the columns of
documents; the last returns one row per row of the mix with its token ids.
"""

from __future__ import annotations

from shelfline.llm import minhash, mixing, quality_rules, secret_ledger, sentencepiece
from shelfline.llm.scratch import read, written


def quality(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality_rules.good_documents(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays."""
    return minhash.one_of_each(docs)


def secrets(spark, docs, sf_dir):
    """Every secret is replaced in its text."""
    return secret_ledger.scrub(docs)


def mix(spark, docs, sf_dir):
    """Every document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark, docs, sf_dir):
    """Token ids of every row of the mix."""
    return sentencepiece.encoded(docs, ["doc_id", "source"])


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mix", mix),
    ("encode", encode),
]

#: The mix and the token ids follow from keyed hashes and a vocabulary file. tests/llm tests each stage by itself and the stages in a row.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
