"""The corpus pipeline: quality rules, language ID, SimHash near-dedup, decontamination, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; ``run``
writes each stage's rows as Parquet in the shared folder and rereads them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyrisk.llm import bpe, decontam, langid, quality, simhash
from tallyrisk.llm.common import materialize, read
from tallyrisk.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.quality_filter(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.language_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.token_digests(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("language id", language_id), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("bpe encoding and decoding", bpe_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{i}-{name.replace(' ', '-')}")
    return docs


# Perplexity bands, language posteriors and BPE are not expressible in SQL: tests/llm checks run().
ORACLE_SQL = None
