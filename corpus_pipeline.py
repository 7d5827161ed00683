"""Corpus preparation, from quality rules to shuffled shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revtide.llm.common import stored, table
from revtide.llm.decontaminate import clean_documents
from revtide.llm.mixing import mixed_documents
from revtide.llm.quality import kept_documents
from revtide.llm.sharding import shuffled
from revtide.llm.simhash import one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and lines over the limit leave the others."""
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, within 3 bits over 3-word shingles, the one with the smallest id stays."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark question go, re-parameterised ones too."""
    return clean_documents(docs, table("benchmark", spark, sf_dir))


def temperature_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source in its tempered share of the tokens; a document is there as often as it is drawn."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in random order, with ``shard`` and ``slot``."""
    return shuffled(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("temperature_mixing", temperature_mixing),
    ("sharding", sharding),
]

#: SQL has neither the hashes nor the permutations of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table("documents", spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
