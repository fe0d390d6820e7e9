"""The registered queries of the operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, density, fingerprint, language, merkle, neardup, quality, quotes, secrets, suffixes, tokens, whitening

VOCABULARY_FILE = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path(VOCABULARY_FILE), public_tokenizers.PATTERN)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.judged(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op3_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.counts(table(spark, sf_dir, "documents"), vocabulary())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.clusters(table(spark, sf_dir, "documents"), neardup.Rule(words=3, percent=85))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.rate(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digests(table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return density.main_text(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_secrets": op2_secrets,
    "op3_repeated_bytes": op3_repeated_bytes,
    "op4_bpe_roundtrip": op4_bpe_roundtrip,
    "op5_fingerprint": op5_fingerprint,
    "op6_token_counts": op6_token_counts,
    "op7_decontaminate": op7_decontaminate,
    "op8_conversations": op8_conversations,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_main_text": op13_main_text,
}

ORACLES: dict[str, str] = {
    "op3_repeated_bytes": suffixes.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op9_near_duplicates": neardup.SQL,
    "op12_merkle": merkle.SQL,
    "op13_main_text": density.SQL,
}
