"""Small tables that hold every awkward case, and plain versions of the operators."""

from __future__ import annotations

import random

LONG = "lorem ipsum dolor sit amet consectetur " * 9000
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wizards boil ten quiet frogs in a deep pot of gold"

AWKWARD = [
    (1, "", "en", "a"),
    (2, None, "en", "a"),
    (3, SENTENCE, None, None),
    (4, SENTENCE, "en", "a"),
    (4, SENTENCE, "en", "a"),
    (None, SENTENCE + " once more", "en", "b"),
    (5, LONG, "en", "b"),
    (6, " \n\t \n", "de", "b"),
    (7, "naïve 漢字 \U0001f642 " * 30, "fr", "c"),
    (8, SENTENCE.upper(), "en", "c"),
]
DOCUMENTS = "doc_id long, text string, lang string, source string"


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCUMENTS)


def clashing(spark):
    """The same rows with columns named like the operators' own."""
    docs = awkward(spark)
    for name in ("row", "id", "host", "words", "lines", "ids", "key", "ord", "spans", "kept", "start", "length", "block", "run",
                 "fp", "vector", "owner", "perplexity", "labels", "count", "_group", "offset", "node", "root", "n_words", "n_chars", "_key", "_ord", "_null"):
        docs = docs.selectExpr("*", f"'x' AS {name}")
    return docs


def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def sentences(seed: int, count: int, words: int = 40) -> list[str]:
    """Different sentences of invented words."""
    dice = random.Random(seed)
    parts = ["ba", "ke", "li", "mo", "nu", "ra", "se", "ti", "vo", "zu"]
    word = lambda: "".join(dice.choice(parts) for _ in range(dice.randint(2, 4)))
    return [" ".join(word() for _ in range(words)) for _ in range(count)]


def plain(rows):
    """Rows in an order of their own, for comparison."""
    return sorted(map(repr, rows))
