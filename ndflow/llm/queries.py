"""Registered queries of this subpackage: each runs its operator with
production parameters over the whole table and returns the digest columns.

Decontamination, substring dedup and the Jaccard join have an SQL twin
(``oracles``); sketches, classifiers, flows, hash orders and tokenizers are not
SQL.  ``tests/llm`` holds each against brute force, an exact round trip or
held-out accuracy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ndflow.llm import bitslice, collocations, decontam, filteraudit, langid, mixing, ngramjoin, oracles, quality, sharding, substrings, tokencount, toxicity, urlrules
from ndflow.llm.frames import id_remainder, table

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def source_shard(source: Column, n: int = sharding.SHARDS) -> Column:
    """The layout documents come from: one shard per source hash."""
    return F.pmod(F.crc32(source.cast("string").cast("binary")), F.lit(n)).cast("int")


@register("op1_reshard")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From shards by source (one is hot) to 16 of equal bytes."""
    docs = table(spark, sf_dir, "documents")
    return sharding.digest(sharding.reshard(docs, spark, source_shard(docs["source"])))


@register("op2_decontaminate", oracles.DECONTAMINATE)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.scan_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@register("op3_substring_dedup", oracles.SUBSTRING_DEDUP)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_digest(table(spark, sf_dir, "documents"))


@register("op4_mix_sources")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.mix(table(spark, sf_dir, "documents"), spark))


@register("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.judge(table(spark, sf_dir, "documents"), spark))


@register("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"), spark)


@register("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    model = langid.train(docs.filter(~held_out), key=F.col("doc_id"))
    x = langid.predict(docs, model)
    return x.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@register("op8_ngram_jaccard", oracles.JACCARD)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, sf_dir, "documents"), spark)


@register("op9_token_counts")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokencount.tokenizer_path())


@register("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out))
    x = toxicity.score(docs, model)
    return x.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


@register("op11_collocations", oracles.COLLOCATIONS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), spark)


@register("op12_topk_search", oracles.TOPK_SEARCH)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_similar(table(spark, sf_dir, "embeddings"), spark)


@register("op13_filter_audit", oracles.FILTER_AUDIT)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), spark)
