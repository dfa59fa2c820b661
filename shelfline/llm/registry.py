"""The queries of this subpackage and the SQL that says what they return."""

from __future__ import annotations

import re

from shelfline.llm import caps, codebooks, debruijn, expected, language, minhash, mixing, phrases, quality_rules, secret_ledger, sentencepiece, sharding, suffixes, warc
from shelfline.llm.scratch import read, shared_folder

#: Bytes of a WARC record's block in the registered query: long pages go on in continuation records.
SEGMENT = 16 << 10


def op1_suffix_dedup(spark, sf_dir):
    return suffixes.removed(read(spark, sf_dir, "documents")).drop("kept")


def op3_quality_rules(spark, sf_dir):
    return quality_rules.verdicts(read(spark, sf_dir, "documents"))


def op2_sharding(spark, sf_dir):
    return sharding.shards(read(spark, sf_dir, "documents"))


def op4_source_mix(spark, sf_dir):
    return mixing.shares(read(spark, sf_dir, "documents"))


def op5_secret_scan(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return secret_ledger.report(docs, secret_ledger.update(docs, shared_folder(spark)))


def op6_warc_segments(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages"), segment=SEGMENT)


def op7_sentencepiece(spark, sf_dir):
    return sentencepiece.encoded(read(spark, sf_dir, "documents"), ["doc_id"])


def op8_byte_cnn(spark, sf_dir):
    return language.predictions(read(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark, sf_dir):
    return minhash.groups(read(spark, sf_dir, "documents"), minhash.CONTRACT)


def op10_cap_filters(spark, sf_dir):
    return caps.groups(read(spark, sf_dir, "embeddings"))


def op11_bounded_codes(spark, sf_dir):
    return codebooks.codes(read(spark, sf_dir, "embeddings")).drop("label")


def op12_son_phrases(spark, sf_dir):
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_debruijn_dedup(spark, sf_dir):
    return debruijn.removed(read(spark, sf_dir, "documents")).drop("kept")


def queries():
    return {name: f for name, f in globals().items() if re.match(r"op\d+_", name)}


def oracle_sql():
    return {
        "op1_suffix_dedup": expected.suffix_dedup(),
        "op2_sharding": sharding.oracle(),
        "op4_source_mix": mixing.oracle(),
        "op5_secret_scan": secret_ledger.oracle(),
        "op6_warc_segments": warc.oracle(),
        "op9_minhash_near_dedup": expected.near_dedup(),
        "op10_cap_filters": expected.vector_links(),
        "op11_bounded_codes": codebooks.oracle(),
        "op12_son_phrases": phrases.oracle(),
        "op13_debruijn_dedup": debruijn.oracle(),
    }
