"""The registered queries of this subpackage, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import (
    bpe, gracehash, licenses, packing, perplexity, pii, postings, quality, secrets, simhash, spelling, suffixes, whitening,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_documents(spark, sf_dir))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(_documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(_documents(spark, sf_dir), "registered query")


def op4_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(_documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(_documents(spark, sf_dir))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.labelled(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gracehash.distinct_texts(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_quality, op2_suffixes, op3_pii, op4_postings, op5_perplexity, op6_simhash, op7_secrets, op8_bpe, op9_licenses,
        op10_packing, op11_spelling, op12_whitening, op13_exact,
    )
    return {f.__name__: f for f in registered}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": quality.sql(), "op9_licenses": licenses.sql(), "op13_exact": gracehash.sql()}
