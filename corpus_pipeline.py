"""Corpus pipeline over ``documents``: quality rules, near copies, benchmark passages, source mix, shards.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's ``docs``.
All but the last return the columns of ``documents``. Empty inputs give empty results in every stage; nulls, repeated
rows and further columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnmill.llm import decontaminate, jaccard, mixing, quality, sharding
from txnmill.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of its five-word shingles."""
    return jaccard.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage aligned to a test item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows repeat."""
    return mixing.mixed_rows(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with shard and place in it. A column with the name of a result column is replaced by it."""
    own = [c for c in docs.columns if c not in sharding.RESULT]
    return sharding.shard(docs, keep=tuple(own)).select("doc_id", *own, *sharding.RESULT[1:])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("benchmark_passages", benchmark_passages),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: SQL cannot express the learned rules, the alignment and the packing; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
