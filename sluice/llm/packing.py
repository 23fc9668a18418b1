"""Packs tokenized documents into training sequences of a fixed length.

Documents are tokenized, closed with an end id and cut into pieces of the sequence length; what is left of
each is placed by first-fit decreasing. A tournament tree over the free room of the open sequences finds
the first one that takes a piece in logarithmic time. Pieces are dealt into random groups of bounded size
and each group is packed alone, so tasks share nothing.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import portions, return_memory, small_batches
from sluice.llm.units import UnitCache
from sluice.session import cut_lineage

# Pieces of a group, on average; a group's ids are then some 16 MB at most for 1,024 tokens.
GROUP = 4096
# Sequence ids of a group: the group's number times this, and up.
SPAN = 1 << 20
_ID = attrgetter("id")
_WORD = re.compile(f" ?[{''.join(c for c in map(chr, range(0x250)) if c.isalpha())}]+").fullmatch


def _byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it prints, else one beyond 255."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Tokens:
    """Ids of texts by the file of a byte-level tokenizer; holds the units that a worker has seen."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        before = repr(self.tokenizer.pre_tokenizer)
        if not before.startswith("ByteLevel(add_prefix_space=False") or self.tokenizer.normalizer is not None:
            raise ValueError(f"not a byte-level tokenizer without normalizer: {path}")
        self.letters = _byte_letters()
        # The pattern of these vocabularies takes a line feed before other text for itself.
        self.cache = UnitCache(self._units, lines="use_regex=True" in before)

    def _units(self, texts: list[str]) -> Iterator[bytes]:
        merge, letters = self.tokenizer.model.tokenize, self.letters
        # A word of Latin letters, maybe behind a space, is not split before the merges, so the model can take it as it is.
        alone = list(map(_WORD, texts))
        rest = iter(self._whole([t for t, word in zip(texts, alone, strict=True) if not word]))
        for text, word in zip(texts, alone, strict=True):
            if word:
                found = merge(text.encode().decode("latin-1").translate(letters))
                yield array("I", map(_ID, found)).tobytes()
            else:
                yield next(rest)

    def _whole(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 10_000):
            found = self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False)
            yield from [array("I", e.ids).tobytes() for e in found]


@lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def pieces(
    docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(``id_col``, start, length, doc_tokens, ids binary): each document's tokens cut every ``length``.

    ``ids`` are little-endian 32-bit values. Without them, ``ids_crc32`` is their checksum: who needs the place of each
    piece only moves no tokens. A null or empty text is the end id alone. Repeated rows and
    null ids stay; other columns are not read.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, kind), *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens"))]
    )
    schema = schema.add("ids", "binary") if with_ids else schema.add("ids_crc32", "long")
    close = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _tokens(tokenizer).cache
        step = 4 * length
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in portions(texts):
                row, start, size, total, ids = [], [], [], [], []
                for i, found in enumerate(cache.ids(texts[first:last]), first):
                    found += close
                    for at in range(0, len(found), step):
                        part = found[at : at + step]
                        row.append(i)
                        start.append(at // 4)
                        size.append(len(part) // 4)
                        total.append(len(found) // 4)
                        ids.append(part if with_ids else crc32(part))
                names = batch.column(0).take(pa.array(row, pa.int64()))
                numbers = [pa.array(x, pa.int64()) for x in (start, size, total)]
                last_column = pa.array(ids, pa.binary() if with_ids else pa.int64())
                yield pa.RecordBatch.from_arrays([names, *numbers, last_column], schema.names)
        return_memory()

    return docs.select(id_col, F.col(text_col)).mapInArrow(run, schema)


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (1 to ``room``), longest first, each into the first bin that takes it.

    Ties keep their order. The tree's leaves are the free room of each bin, every inner node the most
    free room below it; going left whenever the left half has enough finds the first fitting bin.
    """
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [room] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        left = tree[node]
        bins[i], offsets[i] = node - leaves, room - left
        tree[node] = left - size
        node //= 2
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            most = a if a > b else b
            if tree[node] == most:
                break
            tree[node] = most
            node //= 2
    return bins, offsets


def pack(parts: DataFrame, length: int = 1024) -> DataFrame:
    """``parts`` (as ``pieces`` gives them) with sequence_id and offset.

    A full piece is a sequence of its own (with a negative id) and does not move. The others are dealt at
    random, so a document with very many pieces or copies spreads over all groups. Pieces are written
    once before they are dealt: a task that runs again then deals and numbers them alike. An empty
    table gives an empty one.
    """
    kept = cut_lineage(parts)
    full = F.col("length") == length
    groups = max(1, -(-kept.where(~full).count() // GROUP))
    schema = kept.schema.add("sequence_id", "long").add("offset", "long")
    dealt = kept.where(~full).withColumn("_group", (F.rand(10) * groups).cast("int"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        table = table.drop_columns("_group")
        bins, offsets = first_fit_decreasing(table["length"].to_numpy(), length)
        ids = pa.array(group * SPAN + bins)
        return table.append_column("sequence_id", ids).append_column("offset", pa.array(offsets))

    alone = kept.where(full).withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    return alone.withColumn("offset", F.lit(0).cast("long")).unionByName(dealt.groupBy("_group").applyInArrow(run, schema))


def packed(docs: DataFrame, tokenizer: str, length: int = 1024) -> DataFrame:
    """Per piece: place in its document, place in its sequence, and the checksum of its ids."""
    return pack(pieces(docs, tokenizer, length, with_ids=False), length).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
