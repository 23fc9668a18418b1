"""Quality rules: counts over each whole text, and cross-document line frequency.

Lines are normalised and hashed. A line that stands in a large share, or in very many, of a host's different documents
is boilerplate of that host: it is removed, and a document that loses most of its words with such lines is
rejected. Everything is column functions; the text is read once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
# A line is boilerplate of a host if more than the least number of its different documents hold it, and of these
# either more than this share of all of them, or so many that no share is asked of a large host.
LEAST_DOCUMENTS = 5
LEAST_SHARE = 0.05
MANY_DOCUMENTS = 1000
# A document is depleted if more than this share of its words goes with such lines.
DEPLETED = 0.5


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it is named."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that stand twice or more in the text, each word once."""
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1,
        F.greatest(F.lit(0), F.size(words) - 2),
    )

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = bind(
            placed,
            lambda p: F.filter(
                p,
                lambda x, k: x["h"].eqNullSafe(F.get(p, k - 1)["h"]) | x["h"].eqNullSafe(F.get(p, k + 1)["h"]),
            ),
        )
        places = F.array_sort(F.transform(twins, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("sum"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(3), i - a["last"])).alias("sum")),
        )["sum"]

    return bind(
        windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    ).cast("long")


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), BLANKS, " "))


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One staged row per document: id, row number, host, counts, and a hash and word count for each line.

    ``keep`` names further columns to carry, under the prefix ``keep_``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        text.alias("text"),
        *[F.col(c).alias(f"keep_{c}") for c in keep],
    )
    split = read.withColumn("words", words_of(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    )
    counted = split.select(
        "id",
        "host",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("text").alias("text_hash"),
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.transform(
            "lines", lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.size(words_of(x)).alias("n"))
        ).alias("lines"),
        *[f"keep_{c}" for c in keep],
    )
    return cut_lineage(counted)


def boilerplate(
    rows: DataFrame, least_documents: int, least_share: float, many_documents: int
) -> tuple[DataFrame, DataFrame]:
    """Lines with hosts where they are boilerplate, and the lines of documents that could be.

    A line counts once for a document; exact copies on a host count as one document. A first count by rows,
    combined before the shuffle, leaves only frequent lines for the exact one.
    """
    lines = rows.select(
        "row", "host", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h")
    )
    often = lines.groupBy("host", "h").count().where(F.col("count") > least_documents).select("host", "h")
    hits = cut_lineage(lines.join(often, ["host", "h"]))
    texts = rows.groupBy("host", "text_hash").count().groupBy("host").agg(F.count("*").alias("documents"))
    counts = hits.groupBy("host", "h", "text_hash").count().groupBy("host", "h").agg(F.count("*").alias("holders"))
    holders = F.col("holders")
    widely = (holders > least_share * F.col("documents")) | (holders > many_documents)
    found = counts.join(texts, "host").where((holders > least_documents) & widely).select("host", "h")
    return found, hits


def assess(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    least_share: float = LEAST_SHARE,
    many_documents: int = MANY_DOCUMENTS,
    depleted: float = DEPLETED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row: ``id_col``, counts, boilerplate lines (hashes), base_failed and kept.

    A null text has no words; a null host is the empty host. Documents under 50 words, or with over half of their
    words in repeated windows, fail the base rules. Repeated rows and null ids stay; columns other than
    those named are not read.
    """
    rows = measure(docs, id_col, text_col, host_col, keep)
    found, hits = boilerplate(rows, least_documents, least_share, many_documents)
    removed = hits.join(found, ["host", "h"]).groupBy("row").agg(F.collect_set("h").alias("boilerplate"))
    judged = rows.join(removed, "row", "left").withColumn(
        "boilerplate", F.coalesce("boilerplate", F.array().cast("array<bigint>"))
    )
    lost = F.filter("lines", lambda x: F.array_contains("boilerplate", x["h"]))
    judged = judged.withColumn("n_removed_lines", F.size(lost).cast("long")).withColumn(
        "n_removed_words", F.aggregate(lost, F.lit(0).cast("long"), lambda s, x: s + x["n"])
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_removed_lines",
        "n_removed_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("n_removed_words") <= depleted * F.col("n_words"))).alias("kept"),
        "boilerplate",
        *[F.col(f"keep_{c}") for c in keep],
    )


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The kept rows of ``docs``, all columns, their boilerplate lines removed from the text."""
    judged = assess(docs, id_col, text_col, host_col, keep=tuple(docs.columns)).where("kept")
    text = F.col(f"keep_{text_col}")
    left = F.array_join(
        F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("boilerplate", F.xxhash64(normal_line(x)))), "\n"
    )
    cleaned = F.when(F.col("n_removed_lines") > 0, left).otherwise(text)
    return judged.select(*[(cleaned if c == text_col else F.col(f"keep_{c}")).alias(c) for c in docs.columns])


def verdicts(docs: DataFrame) -> DataFrame:
    return assess(docs).drop("boilerplate")


def sql() -> str:
    """The same rows in DuckDB SQL."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT r, i, words[i:i + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(0, 3) AS t(k) GROUP BY r),
line AS (
  SELECT r, host, text, trim(regexp_replace(lower(x), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line,
    len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS n
  FROM (SELECT r, host, text, unnest(lines) AS x FROM d)),
hosts AS (SELECT host, count(DISTINCT text) AS documents FROM d GROUP BY host),
found AS (
  SELECT host, line FROM line JOIN hosts USING (host) GROUP BY host, line, documents
  HAVING count(DISTINCT text) > {LEAST_DOCUMENTS} AND
    (count(DISTINCT text) > {LEAST_SHARE} * documents OR count(DISTINCT text) > {MANY_DOCUMENTS})),
lost AS (SELECT r, count(*) AS n_removed_lines, sum(n) AS n_removed_words FROM line JOIN found USING (host, line) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(n_removed_words, 0)::BIGINT AS n_removed_words,
    len(words) < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * len(words) AS base_failed
  FROM d LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT *, NOT base_failed AND n_removed_words <= {DEPLETED} * n_words AS kept FROM m
"""
