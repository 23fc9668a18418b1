"""Exact dedup by Grace hashing: records go to spill files by hash until each bucket fits a table in memory.

Texts are equal when they are identical after every run of blanks became one space. Each task first collapses
the copies among its own rows in a bounded open-addressing table, so a text that a third of all rows hold
moves once per task. What is left is dealt to buckets by a hash of the content and written; a bucket goes through
an open-addressing table that compares complete content and closes when it is full. Records that a closed
table does not hold are spilled, dealt anew by other hash bits, and so on until nothing is left.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import return_memory, small_batches
from sluice.session import cut_lineage, shared_folder

# Content one table holds before it closes; a bucket is planned at half of it.
TABLE_BYTES = 32 << 20
# Buckets dealt out at once; more are first parted into portions that follow one another.
FANOUT = 8192

_BLANKS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def normalise(text: bytes) -> bytes:
    """Every run of ``[\\x20\\x09-\\x0D]`` as one space."""
    text = text.translate(_BLANKS)
    while b"  " in text:
        # Runs shrink to less than half in a round, so the rounds grow with the logarithm of the longest run.
        text = text.replace(b"        ", b" ").replace(b"  ", b" ")
    return text


class Table:
    """Open addressing with linear probing over content that is kept whole; closes when ``limit`` bytes are held."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.held = 0
        self.closed = False
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.slots = np.full(1 << 10, -1, np.int64)

    def _place(self, digest: int) -> int:
        mask = len(self.slots) - 1
        at = digest & mask
        while self.slots[at] >= 0:
            at = at + 1 & mask
        return at

    def find(self, digest: int, content: bytes) -> int:
        """Number of the entry with this content, a new one if there is none, -1 if the table is closed."""
        mask = len(self.slots) - 1
        at = digest & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == digest and self.contents[entry] == content:
                return int(entry)
            at = at + 1 & mask
        if self.closed:
            return -1
        entry = len(self.contents)
        self.contents.append(content)
        self.hashes.append(digest)
        self.slots[at] = entry
        self.held += len(content) + 128
        # The first entry always finds room, so each level settles something of every bucket.
        self.closed = self.held >= self.limit
        if 2 * len(self.contents) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int64)
            for k, known in enumerate(self.hashes):
                self.slots[self._place(known)] = k
        return entry


def _order(row: tuple) -> tuple:
    """Least id first, null ids last, then the row number."""
    return (row[0] is None, row[0], row[1]) if row[0] is not None else (True, 0, row[1])


def _records(docs: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """A member row (row, id, rep) for each input row, and a record for each text of a task's table:
    (rep, id and row of the least member, n, sha, size, body)."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("rep", T.LongType()),
            T.StructField("n", T.LongType()), T.StructField("sha", T.BinaryType()), T.StructField("size", T.LongType()),
            T.StructField("body", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shas, reps, least, counts = Table(limit), [], [], [], []
        pack = zstandard.ZstdCompressor(level=1).compress
        arrow = None

        def flush() -> Iterator[pa.RecordBatch]:
            for a, b in _parts(table.contents):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[1] for x in least[a:b]], pa.int64()), pa.array([x[0] for x in least[a:b]], arrow),
                        pa.array(reps[a:b], pa.int64()), pa.array(counts[a:b], pa.int64()),
                        pa.array(shas[a:b], pa.binary()), pa.array([len(c) for c in table.contents[a:b]], pa.int64()),
                        pa.array([pack(c) for c in table.contents[a:b]], pa.binary()),
                    ],
                    schema.names,
                )
            table.clear()
            for held in (shas, reps, least, counts):
                held.clear()

        for batch in batches:
            arrow = batch.column(1).type
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rep = []
            for row, own, text in zip(rows, ids, batch.column(2), strict=True):
                content = normalise(text.as_py() or b"")
                sha = hashlib.sha256(content).digest()
                entry = table.find(int.from_bytes(sha[:8], "little"), content)
                if entry < 0:
                    # Full: what it holds goes out, and the table starts anew.
                    yield from _members(rows, ids, rep, arrow, schema)
                    rows, ids, rep = rows[len(rep) :], ids[len(rep) :], []
                    yield from flush()
                    entry = table.find(int.from_bytes(sha[:8], "little"), content)
                if entry == len(reps):
                    reps.append(row)
                    shas.append(sha)
                    least.append((own, row))
                    counts.append(0)
                counts[entry] += 1
                least[entry] = min(least[entry], (own, row), key=_order)
                rep.append(reps[entry])
            yield from _members(rows, ids, rep, arrow, schema)
        yield from flush()
        return_memory()

    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return read.mapInArrow(run, schema)


def _members(rows: list, ids: list, rep: list, arrow: pa.DataType, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    if rep:
        none = [pa.nulls(len(rep), t) for t in (pa.int64(), pa.binary(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[: len(rep)], pa.int64()), pa.array(ids[: len(rep)], arrow), pa.array(rep, pa.int64()), *none], schema.names
        )


def _parts(contents: list[bytes], size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, content in enumerate(contents):
        held += len(content)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(contents):
        yield start, len(contents)


def _through_tables(records: DataFrame, limit: int) -> DataFrame:
    """Every partition as one bucket through a table: records of texts it holds are settled, the others spilled."""
    id_type, names = records.schema["id"].dataType, records.columns
    schema = T.StructType(
        [
            *records.schema.fields, T.StructField("settled", T.BooleanType()), T.StructField("keep_row", T.LongType()),
            T.StructField("keep_id", id_type), T.StructField("group_size", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(limit)
        least: list[tuple] = []
        counts: list[int] = []
        members: list[list] = []
        shas: list[bytes] = []
        unpack = zstandard.ZstdDecompressor().decompress
        arrow = None
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            column = {c: batch.column(at[c]).to_pylist() for c in ("row", "id", "rep", "n", "sha")}
            arrow = batch.column(at["id"]).type
            spilled = []
            for k, body in enumerate(batch.column(at["body"])):
                content = unpack(body.as_py())
                sha = column["sha"][k]
                entry = table.find(int.from_bytes(sha[:8], "little"), content)
                if entry < 0:
                    spilled.append(k)
                    continue
                own = (column["id"][k], column["row"][k])
                if entry == len(least):
                    least.append(own)
                    counts.append(0)
                    members.append([])
                    shas.append(sha)
                counts[entry] += column["n"][k]
                least[entry] = min(least[entry], own, key=_order)
                members[entry].append(column["rep"][k])
            if spilled:
                rest = batch.take(pa.array(spilled))
                none = [pa.array([False] * len(spilled)), *(pa.nulls(len(spilled), t) for t in (pa.int64(), arrow, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(rest.column(at[name]) for name in names), *none], schema.names)
        # What is left to say needs no content.
        table.clear()
        return_memory()
        for start in range(0, len(least), 4096):
            entries = [e for e in range(start, min(start + 4096, len(least))) for _ in members[e]]
            n = len(entries)
            own = {
                "rep": pa.array([r for m in members[start : start + 4096] for r in m], pa.int64()),
                "sha": pa.array([shas[e] for e in entries], pa.binary()),
                "settled": pa.array([True] * n),
                "keep_row": pa.array([least[e][1] for e in entries], pa.int64()),
                "keep_id": pa.array([least[e][0] for e in entries], arrow),
                "group_size": pa.array([counts[e] for e in entries], pa.int64()),
            }
            kinds = {"id": arrow, "body": pa.binary()}
            yield pa.RecordBatch.from_arrays(
                [own[f.name] if f.name in own else pa.nulls(n, kinds.get(f.name, pa.int64())) for f in schema.fields], schema.names
            )

    return records.mapInArrow(run, schema)


def _settle(records: DataFrame, level: int, limit: int, fanout: int) -> Iterator[DataFrame]:
    """(rep, sha, keep_row, keep_id, group_size) for all records, some at each level."""
    spark = records.sparkSession
    # Copies that many tasks hold need room once.
    size, different = records.groupBy("sha").agg(F.max("size").alias("size")).agg(F.sum(F.col("size") + 128), F.count("*")).first()
    if not different:
        return
    buckets = min(math.ceil(2 * size / limit), different)
    digit = F.xxhash64("sha", F.lit(level))
    if buckets > fanout:
        portions = math.ceil(buckets / fanout)
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
        records.withColumn("portion", F.pmod(digit, F.lit(portions)).cast("int")).write.partitionBy("portion").parquet(path)
        parted = spark.read.parquet(path)
        for portion in range(portions):
            yield from _settle(parted.where(F.col("portion") == portion).select(*records.columns), level + 1, limit, fanout)
        return
    done = cut_lineage(_through_tables(records.repartition(buckets, digit), limit))
    yield done.where("settled").select("rep", "sha", "keep_row", "keep_id", "group_size")
    yield from _settle(done.where("NOT settled").select(*records.columns), level + 1, limit, fanout)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, fanout: int = FANOUT
) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, sha (of the normalised text).

    A null text is empty; empty texts are equal like any other. Of equal texts the row with the least id stays, the
    first of them if an id repeats; null ids come last. Repeated rows stay, one row each, and one of them
    is kept. Very long texts are compared whole: a text longer than a table has one to itself. Other columns are not
    read, whatever their names. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    staged = cut_lineage(_records(docs, id_col, text_col, table_bytes))
    records = staged.where(F.col("n").isNotNull())
    groups = None
    for part in _settle(records, 0, table_bytes, fanout):
        groups = part if groups is None else groups.unionByName(part)
    members = staged.where(F.col("n").isNull()).select("row", "id", "rep")
    if groups is None:
        empty = members.limit(0)
        return empty.select(
            F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(None).cast("long").alias("group_size"),
            F.lit(None).cast("boolean").alias("kept"), F.lit(None).cast("binary").alias("sha"),
        )
    return members.join(groups, "rep").select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "sha"
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Per document: the row that stays for its text, how many rows share it, and the SHA-256 of the normalised text."""
    return exact_groups(docs).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def sql() -> str:
    """The same rows in DuckDB SQL."""
    return r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST, r)
"""
