"""License scan: phrases in whole texts, and an exact set-similarity join of text blocks with templates.

A block is a window of ``BLOCK`` words (more for a longer template), half overlapping, so any passage of half a block
lies whole in one.
Template words are ordered by how many blocks of the whole corpus hold them, the rarest first. A block can
hold enough of a template only if it holds one of the first words of that order (prefix filter), has
enough template words at all (length filter), and has enough of them left behind the first shared one
(positional filter). What passes is verified. Everything is column functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices and key paragraphs of public licenses, with their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files, to deal in the Software without restriction, including without limitation the "
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 256
THRESHOLD = 0.85
# Of a template with fewer words none may be missing: one word is what tells short notices apart.
SHORT = 20


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered; null has none.

    The Kelvin sign is the one other character whose lower case is an ASCII letter that a word could
    hold alone, so it is set apart first.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))
    return F.array_remove(F.split(F.lower(plain), SEPARATORS), "")


def template_words(text: str) -> list[str]:
    cleaned = "".join(c if c.isalnum() else " " for c in text.lower())
    return sorted(set(cleaned.split()))


def needed(count: int, threshold: float) -> int:
    """Least shared words that reach the threshold; all of a short template."""
    return count if count < SHORT else math.ceil(threshold * count - 1e-9)


def _blocks(found: Column, vocabulary: list[str], size: int) -> Column:
    """Start and template words (in the order of ``vocabulary``) of each block of ``size`` words."""
    step = size // 2
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(found) - step - 1), F.lit(step))
    known = F.array(*map(F.lit, vocabulary))
    return F.transform(
        starts,
        lambda i: F.struct(i.alias("start"), F.array_intersect(known, F.slice(found, i + 1, F.lit(size))).alias("tokens")),
    )


def by_frequency(blocks: DataFrame, vocabulary: list[str]) -> list[str]:
    """``vocabulary`` from the rarest to the most frequent word, by blocks of the whole corpus."""
    # At most one row for each word of the fixed templates.
    counts = blocks.select(F.explode("tokens").alias("w")).groupBy("w").count().collect()
    often = {r["w"]: r["count"] for r in counts}
    return sorted(vocabulary, key=lambda w: (often.get(w, 0), w))


def _places(found: Column, phrase: str) -> Column:
    """Where the words of ``phrase`` stand one after another."""
    parts = phrase.split()
    at = F.filter(
        F.sequence(F.lit(0), F.size(found) - 1),
        lambda i: F.forall(
            F.arrays_zip(F.array(*map(F.lit, parts)).alias("p"), F.slice(found, i + 1, F.lit(len(parts))).alias("w")),
            lambda z: z["p"].eqNullSafe(z["w"]),
        ),
    )
    rare = F.array_contains(found, parts[0]) & F.array_contains(found, parts[-1])
    return F.when(rare, at).otherwise(F.array().cast("array<int>"))


def scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: n_words, n_base, first_word, last_word, base_labels, labels, score, and matches
    (array of label, start word of the block, share of the template's words it holds).

    Templates of fewer than ``SHORT`` words need all of them. ``score`` is the largest share of a match that reaches ``threshold``, 1 where a phrase stands, else 0.
    A null or empty text has no words and no label. Repeated rows and null ids stay; other columns are not read.
    """
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    least = min(needed(len(ws), threshold) for _, ws in sets)
    # Half a block holds the longest template, so none falls between two blocks.
    size = max(BLOCK, 2 * max(len(text.split()) for _, text in templates))

    spark = docs.sparkSession
    read = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("words"))
    # The text is read once; blocks too poor for any template are left here.
    rows = cut_lineage(
        read.select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.size("words").cast("long").alias("n_words"),
            F.array(
                *[F.struct(F.lit(label).alias("label"), _places(F.col("words"), p).alias("at")) for p, label in phrases.items()]
            ).alias("base"),
            F.filter(_blocks(F.col("words"), vocabulary, size), lambda b: F.size(b["tokens"]) >= least).alias("blocks"),
        )
    )
    blocks = rows.select("row", F.explode("blocks").alias("b")).select("row", "b.start", "b.tokens")

    order = by_frequency(blocks, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    index = [
        (word, place, label, ws, needed(len(ws), threshold))
        for label, ws in ((label, sorted(ws, key=rank.__getitem__)) for label, ws in sets)
        for place, word in enumerate(ws[: len(ws) - needed(len(ws), threshold) + 1])
    ]
    prefixes = F.array(*map(F.lit, sorted({row[0] for row in index})))
    lookup = spark.createDataFrame(index, "word string, place int, label string, template_words array<string>, needed int")
    ordered = blocks.where(F.arrays_overlap("tokens", prefixes)).select(
        "row", "start", F.array_intersect(F.array(*map(F.lit, order)), "tokens").alias("tokens")
    )
    hits = ordered.select("row", "start", "tokens", F.posexplode("tokens").alias("at", "word")).where(
        F.array_contains(prefixes, F.col("word"))
    )
    possible = hits.join(lookup, "word").where(
        (F.size("tokens") >= F.col("needed"))
        & (1 + F.least(F.size("template_words") - F.col("place") - 1, F.size("tokens") - F.col("at") - 1) >= F.col("needed"))
    )
    shared = F.size(F.array_intersect("template_words", "tokens"))
    verified = possible.where(shared >= F.col("needed")).select(
        "row",
        F.struct("label", F.col("start").cast("long").alias("start"), (shared / F.size("template_words")).alias("share")).alias("m"),
    )
    found = verified.groupBy("row").agg(F.array_sort(F.collect_set("m")).alias("matches"))

    places = F.flatten(F.transform("base", lambda b: b["at"]))
    base_labels = F.transform(F.filter("base", lambda b: F.size(b["at"]) > 0), lambda b: b["label"])
    matches = F.coalesce("matches", F.array().cast("array<struct<label:string,start:bigint,share:double>>"))
    named = F.array_union(base_labels, F.transform(matches, lambda m: m["label"]))
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(named)), ",").alias("labels"),
        F.when(F.size(places) > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform(matches, lambda m: m["share"])), F.lit(0.0)))
        .alias("score"),
        matches.alias("matches"),
    )


def labelled(docs: DataFrame) -> DataFrame:
    return scan(docs).drop("matches")


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def sql() -> str:
    """The same rows in DuckDB SQL: every block against every template, without filters."""
    rows = ", ".join(f"('{label}', {_sql_list(template_words(text))})" for label, text in TEMPLATES)
    phrases = ", ".join(f"('{label}', {_sql_list(p.split())})" for p, label in PHRASES.items())
    return rf"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rn, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words FROM documents),
phrases AS (SELECT * FROM (VALUES {phrases}) AS p(label, parts)),
templates AS (SELECT * FROM (VALUES {rows}) AS t(label, parts)),
places AS (
  SELECT rn, label, unnest(list_filter(range(len(words)), lambda i: words[i + 1 : i + len(parts)] = parts)) AS place
  FROM w, phrases),
base AS (
  SELECT rn, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY rn),
blocks AS (
  SELECT rn, list_distinct(words[s + 1 : s + {BLOCK}]) AS tokens
  FROM (SELECT rn, words, unnest(range(0, greatest(1, len(words) - {BLOCK // 2}), {BLOCK // 2})) AS s FROM w)),
shares AS (
  SELECT rn, label, len(list_intersect(tokens, parts)) AS shared, len(parts) AS parts FROM blocks, templates),
matched AS (
  SELECT rn, list(DISTINCT label) AS labels, max(shared / parts) AS score FROM shares
  WHERE shared >= CASE WHEN parts < {SHORT} THEN parts ELSE ceil({THRESHOLD} * parts - 1e-9) END GROUP BY rn)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(base.labels, []) || coalesce(matched.labels, []))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0)::DOUBLE END AS score
FROM w LEFT JOIN base USING (rn) LEFT JOIN matched USING (rn)
"""
