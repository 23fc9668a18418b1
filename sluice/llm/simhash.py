"""SimHash fingerprints, and near duplicates by multi-index hashing.

A fingerprint is two segments, and a table holds every fingerprint under the value of each. Fingerprints that differ in
at most two bits are within one bit in one of the segments, so each fingerprint looks up the Hamming ball of radius one
around both of its values, and complete distances verify what it finds. A value that many fingerprints share is
split by the other segment: its entries stand there under the ball around the rest, so no lookup
meets more than a bounded number. Copies collapse to one fingerprint before any key is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import portions, small_batches
from sluice.llm.graph import components
from sluice.session import cut_lineage

SEED = 42
BITS = 64
WIDTH = 32
# Entries of a segment value beyond which it is split by the other segment.
CROWDED = 64


def shingles(text: bytes, size: int) -> list[bytes]:
    """Space-joined runs of ``size`` words, A-Z lowered; a shorter text is one run, no words are none."""
    words = text.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.append(0, gaps + 1)[: len(words) - size + 1].tolist()
    ends = np.append(gaps, len(line))[size - 1 :].tolist()
    return [line[a:b] for a, b in zip(starts, ends, strict=True)]


def fingerprints(runs: list[list[bytes]]) -> np.ndarray:
    """Fingerprint of each document's shingles: a bit is set where over half the hashes set it."""
    counts = np.array([len(r) for r in runs], np.int64)
    out = np.zeros((len(runs), BITS), bool)
    full = np.flatnonzero(counts)
    block, held = [], 0
    digest = xxhash.xxh64_intdigest
    for at, i in enumerate(full.tolist()):
        block.append(i)
        held += counts[i]
        if held < 1 << 18 and at < len(full) - 1:
            continue
        hashes = np.fromiter((digest(s, SEED) for j in block for s in runs[j]), np.uint64, held)
        sizes = counts[block]
        total = np.zeros((len(block), BITS), np.int64)
        # A very long text is summed in parts.
        owner = np.repeat(np.arange(len(block)), sizes)
        for a in range(0, held, 1 << 18):
            bits = np.unpackbits(hashes[a : a + (1 << 18)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            mine = owner[a : a + (1 << 18)]
            heads = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            total[mine[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        out[block] = 2 * total > sizes[:, None]
        block, held = [], 0
    return np.packbits(out, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def fingerprint(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fp long): the 64-bit SimHash of each whole text over its ``size``-word shingles.

    Shingles repeat as often as they stand in the text. A null or empty text, or one without words, has
    fingerprint 0. One row per input row; other columns are not read.
    """
    small_batches(docs.sparkSession)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for start, end in portions(texts, 1 << 20):
                found = fingerprints([shingles(t, size) for t in texts[start:end]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[start:end], pa.array(found.view(np.int64))], schema.names
                )

    return docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(run, schema)


def ball(value: Column) -> Column:
    """The values of a segment one bit away."""
    return F.array(*[value.bitwiseXOR(F.lit(1 << bit)) for bit in range(WIDTH)])


def links(prints: DataFrame) -> DataFrame:
    """(a, b) over distinct fingerprints ``fp``: all pairs at 2 bits or fewer, some several times."""
    low, high = F.col("fp").bitwiseAND((1 << WIDTH) - 1), F.shiftrightunsigned("fp", WIDTH)
    entry = lambda i, value, rest: F.struct(F.lit(i).alias("segment"), value.alias("value"), rest.alias("rest"))
    table = prints.select("fp", F.inline(F.array(entry(0, low, high), entry(1, high, low))))
    crowded = cut_lineage(table.groupBy("segment", "value").count().where(F.col("count") > CROWDED).select("segment", "value"))
    by = ["segment", "value"]
    wanted = table.select("segment", "rest", F.col("fp").alias("a"), F.col("value").alias("own"))
    wanted = wanted.select("segment", "rest", "a", "own", F.explode(F.concat(F.array("own"), ball(F.col("own")))).alias("value"))
    found = wanted.select(*by, "a").join(table.join(crowded, by, "left_anti").select(*by, F.col("fp").alias("b")), by)

    # Within a crowded value the rest differs by two bits at most, or by one if the value itself is one bit away.
    around = lambda c: F.concat(F.array(c), ball(F.col(c)))
    split = table.join(crowded, by, "left_semi").select(*by, F.explode(around("rest")).alias("rest"), F.col("fp").alias("b"))
    asked = wanted.join(crowded, by, "left_semi")
    asked = asked.select(*by, "a", F.explode(F.when(F.col("value") == F.col("own"), around("rest")).otherwise(F.array("rest"))).alias("rest"))
    more = asked.join(split, [*by, "rest"])
    pairs = found.select("a", "b").unionAll(more.select("a", "b")).where("a < b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)


def near_groups(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fp, component_id): documents linked by fingerprints that differ in 2 bits or fewer.

    ``component_id`` is the least id that can be reached, the own one included (null where no member has
    one). Texts without words share fingerprint 0 and are linked like any other. Repeated rows and rows with
    a null id stay, one row each.
    """
    prints = cut_lineage(fingerprint(docs, size, id_col, text_col))
    kinds = cut_lineage(prints.groupBy("fp").agg(F.min(id_col).alias("first")))
    roots = components(links(kinds))
    rooted = kinds.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(groups, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(id_col, "fp", "component_id")


def grouped(docs: DataFrame) -> DataFrame:
    """Per document: fingerprint as 16 lowercase hex digits, and its component."""
    return near_groups(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
