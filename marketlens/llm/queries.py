"""Registered queries of the operators and, where SQL expresses them, their
DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.llm import (
    alignment, covertree, decontam, langid, lexical, mixing, secrets, sharding, simhash, substrings, surrogates,
    tokens, urlfilter)
from marketlens.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = surrogates.replace_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", *[f"n_{k}" for k in surrogates.KINDS])


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(_table(spark, sf_dir, "documents"), k=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fp("fp").alias("fingerprint"), "component_id")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    tokens.write_tokens(_table(spark, sf_dir, "documents"), path)
    return tokens.read_documents(spark, path)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op7_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = covertree.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)
    return found.withColumnRenamed("id", "vec_id")


def op8_rendezvous_shards(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = sharding.assign(docs, [1.0] * shards).withColumn(
        "grown_shard", sharding.shard_of(F.col("doc_id"), [1.0] * (shards + 1)))
    slotted = sharding.with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])
    return slotted.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op12_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(_table(spark, sf_dir, "documents"), keep_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_pii_surrogates, op3_simhash_dedup, op4_token_ids, op5_mix_sources, op6_decontaminate,
    op7_cover_tree_dedup, op8_rendezvous_shards, op9_url_filter,
    op10_language_id, op11_ranked_search, op12_repeated_substrings,
    op13_cross_tokenizer)}
ORACLE_SQL = {
    "op5_mix_sources": mixing.oracle_sql(),
    "op9_url_filter": urlfilter.oracle_sql(),
    "op11_ranked_search": lexical.oracle_sql(),
}
