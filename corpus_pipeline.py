"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read back as the next one's input.

1. ``language``       documents without letters or a recognisable language go
2. ``near_dedup``     one document of each SimHash group stays
3. ``decontaminate``  documents that hold a benchmark passage go
4. ``mix``            documents are repeated or left out to the target weights
5. ``tokens``         texts become token-ID shards, read back per document

All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontam, langid, mixing, simhash, tokens
from marketlens.session import materialize, scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(docs, k=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pipeline-tokens")
    # the workers also hold what the earlier stages left: a smaller cache than op4's
    tokens.write_tokens(docs, path, cache_pieces=300_000, group_chars=2 << 20)
    return tokens.read_documents(spark, path)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# Model fitting, components and tokenizing are beyond SQL; tests compare the
# stages with brute force.
ORACLE_SQL = None
