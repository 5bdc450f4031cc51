"""The registered queries of the corpus operators, each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import alignment, bpe, chat, decontaminate, jaccard, licenses, lm, mixing, prefixes, quality, sharding, substrings, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", *quality.BASE_STATS, "base_failed", "kept", "rule")


@query("op10_source_mixing", mixing.oracle())
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query("op5_vector_sharding")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "n_tokens"
    )


@query("op6_license_scan")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents")).drop("spans")


@query("op8_ngram_jaccard_join")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf, "documents")).drop("removed")


@query("op4_benchmark_decontamination")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_warc_archives", warc.oracle())
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_cross_entropy_difference")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    # The target is labelled good and not toxic.
    return lm.score(docs, labels.where("quality = 1 and toxic = 0"))


@query("op1_preference_pairs", chat.oracle())
def op1(spark: SparkSession, sf: str) -> DataFrame:
    pairs = chat.preferences(table(spark, sf, "conversations"))
    return pairs.withColumns({c: chat.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


@query("op11_conversation_trie", prefixes.oracle())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return prefixes.trie(table(spark, sf, "conversations"))


@query("op12_bpe_encoding")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(table(spark, sf, "documents"))


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.align(table(spark, sf, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
