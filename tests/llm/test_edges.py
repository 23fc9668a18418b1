"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import public_tokenizers
import pytest

import corpus_pipeline
from sluice.llm import bpe, licenses, nearcopies, packing, perplexity, pii, postings, quality, secrets, simhash, suffixes
from tests.llm.helpers import AWKWARD, awkward, clashing, nothing, plain

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

OPERATORS = {
    "quality": lambda d: quality.assess(d),
    "clean": lambda d: quality.clean(d).select("doc_id", "text"),
    "suffixes": lambda d: suffixes.find_repeats(d),
    "remove_repeats": lambda d: suffixes.remove_repeats(d).select("doc_id", "text"),
    "pii": lambda d: pii.mask(d, "k").select("doc_id", "text"),
    "perplexity": lambda d: perplexity.classify(d, d.sparkSession.createDataFrame([(4, 1), (None, 1), (3, 0)], "doc_id long, quality int")),
    "simhash": lambda d: simhash.near_groups(d),
    "nearcopies": lambda d: nearcopies.drop_near_copies(d).select("doc_id", "text"),
    "secrets": lambda d: secrets.scan(d),
    "bpe": lambda d: bpe.encode(d, RANKS, public_tokenizers.PATTERN),
    "licenses": lambda d: licenses.scan(d),
    "packing": lambda d: packing.packed(d, TOKENIZER).drop("sequence_id", "offset"),
}
FEWER = ("clean", "nearcopies", "packing")


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, name):
    rows = OPERATORS[name](awkward(spark)).collect()
    if name not in FEWER:
        assert sorted(map(str, (r["doc_id"] for r in rows))) == sorted(str(a[0]) for a in AWKWARD)
    again = OPERATORS[name](clashing(spark)).collect()
    assert plain(again) == plain(rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](nothing(spark)).count() == 0


def test_stages_keep_columns(spark):
    docs = clashing(spark).drop("start", "length", "offset")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns
        after.collect()
        assert stage(spark, docs.limit(0), "").count() == 0


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5]), (40, [])]
    found = postings.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    assert got == [(0, 1, 1, 0.5), (0, 2, 8, 0.5), (0, 3, 20, 0.0), (20, 1, 1, 0.5), (20, 2, 8, 0.5), (20, 3, 0, 0.0)]
    assert postings.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
