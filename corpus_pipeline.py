"""The corpus pipeline: quality rules, near-dedup, passage dedup, pseudonyms, packing.

Every stage works on all that its predecessor kept, and is written and read again before the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import nearcopies, packing, pii, quality, suffixes
from sluice.session import cut_lineage


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it now is."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(quality.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.drop_near_copies(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(suffixes.remove_repeats(docs))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _sized(pii.mask(docs, "corpus pipeline"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("pii", pseudonyms),
    ("packing", pack),
]

# Fingerprints, token ids and keyed permutations have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
