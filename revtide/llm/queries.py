"""The text operators over the sample tables, by query name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtide.llm import decontaminate as op5
from revtide.llm import language_id as op2
from revtide.llm import minhash as op13
from revtide.llm import mixing as op8
from revtide.llm import phrases as op12
from revtide.llm import pii as op3
from revtide.llm import quality as op10
from revtide.llm import sharding as op7
from revtide.llm import simhash as op1
from revtide.llm import token_counts as op9
from revtide.llm import token_store as op6
from revtide.llm import treap_search as op11
from revtide.llm import warc as op4
from revtide.llm.common import scratch_dir, table
from revtide.llm.oracle import PHRASES, QUALITY, RANKED, WARC


def op1_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = op1.near_duplicates(table("documents", spark, sf))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_ppm_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table("documents", spark, sf)
    return op2.predict(documents, op2.learn(documents))


def op3_pii_weak_supervision(spark: SparkSession, sf: str) -> DataFrame:
    return op3.digests(table("documents", spark, sf))


def op4_warc_normaliser(spark: SparkSession, sf: str) -> DataFrame:
    records = op4.round_trip(table("pages", spark, sf), scratch_dir(spark, "warc"))
    return records.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "block_bytes", "intact"
    )


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = op5.leaks(table("documents", spark, sf), table("benchmark", spark, sf))
    return found.select("doc_id", "item_id", "covered", "n_tokens", "same_values")


def op6_token_ids_orc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    op6.write_tokens(table("documents", spark, sf), path, public_tokenizers.path("word_bpe_49k.json"))
    return op6.token_index(spark, path)


def op7_two_pass_sharding(spark: SparkSession, sf: str) -> DataFrame:
    documents, path = table("documents", spark, sf), scratch_dir(spark, "shards")
    op7.write_shards(documents, path)
    placed = op7.digests(op7.read_shards(documents, path), "shard", "slot")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_temperature_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return op8.mix(table("documents", spark, sf)).select(
        "doc_id", "source", "tokens", "copy", "first_token", "block", "place"
    )


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return op9.token_counts(table("documents", spark, sf), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return op10.quality(table("documents", spark, sf)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words",
    )


def op11_treap_search(spark: SparkSession, sf: str) -> DataFrame:
    index = op11.build_index(table("documents", spark, sf))
    return op11.search(index, table("benchmark", spark, sf), "item_id")


def op12_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return op12.collocations(table("documents", spark, sf))


def op13_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = op13.near_duplicates(table("documents", spark, sf))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_ppm_language_id": op2_ppm_language_id,
    "op3_pii_weak_supervision": op3_pii_weak_supervision,
    "op4_warc_normaliser": op4_warc_normaliser,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_token_ids_orc": op6_token_ids_orc,
    "op7_two_pass_sharding": op7_two_pass_sharding,
    "op8_temperature_mixing": op8_temperature_mixing,
    "op9_token_counts": op9_token_counts,
    "op10_quality_rules": op10_quality_rules,
    "op11_treap_search": op11_treap_search,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

ORACLE = {
    "op4_warc_normaliser": WARC,
    "op10_quality_rules": QUALITY,
    "op11_treap_search": RANKED,
    "op12_phrase_collocations": PHRASES,
}
