"""Byte-level BPE encoding and decoding by corpus-level merge replay.

Each task gathers the distinct pieces of its part of the corpus, lays them out as one long chain of
byte tokens and builds an inverted index from each mergeable pair to the places where it stands.
Merges are then applied in rank order, each to all of its places at once, and every application
updates the index only for the two neighbours it touched. No document is merged on its own, and no
piece is merged twice by a worker.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import portions, small_batches
from sluice.llm.units import UnitCache

# Pieces replayed together.
BLOCK = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a rank file (one base64 token and its rank a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The merges of a rank table: which pair of token ids makes which token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, made = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        order = np.argsort(keys)
        # A closing key that no pair has keeps every search inside the array.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int64)[order], -1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair makes, or -1."""
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.made[at], -1)


# Stands for "no neighbour" in the chain of symbols; no token has it.
_NONE = (1 << 31) - 1


def replay(pieces: list[bytes], merges: Merges) -> list[bytes]:
    """Ids of each non-empty piece (little-endian, 32 bits each), all merged together in rank order."""
    length = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(length)
    starts = ends - length
    n = int(ends[-1])
    symbol = np.append(merges.single[np.frombuffer(b"".join(pieces), np.uint8)], _NONE)
    after = np.arange(1, n + 2)
    after[ends - 1] = after[n] = n
    before = np.arange(-1, n)
    before[starts] = n
    pair = merges.merged(symbol, symbol[after])  # the token that a symbol makes with the next one
    places: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []
    odd: set[int] = set()

    def index(made: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(made, kind="stable")
        made, at = made[order], at[order]
        cuts = np.flatnonzero(made[1:] != made[:-1]) + 1
        for rank, part in zip(made[np.append(0, cuts)].tolist(), np.split(at, cuts), strict=True):
            if rank in places:
                places[rank].append(part)
            else:
                places[rank] = [part]
                heappush(heap, rank)

    some = np.flatnonzero(pair >= 0)
    if len(some):
        index(pair[some], some)
    while heap:
        rank = heappop(heap)
        parts = places.pop(rank)
        at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        at = at[pair[at] == rank]
        if not len(at):
            continue
        if len(at) > 1:
            # Of places that overlap in a row, the first, third, ... are merged.
            tied = after[at[:-1]] == at[1:]
            if tied.any():
                head = np.append(0, np.where(tied, 0, np.arange(1, len(at))))
                at = at[(np.arange(len(at)) - np.maximum.accumulate(head)) % 2 == 0]
        gone = after[at]
        right = after[gone]
        symbol[at], symbol[gone], pair[gone] = rank, -1, -1
        after[at], before[right] = right, at
        left = before[at]
        left = left[left < n]
        touched = np.concatenate((at, left))
        made = merges.merged(symbol[touched], symbol[after[touched]])
        pair[touched] = made
        good = made >= 0
        if good.any():
            made, touched = made[good], touched[good]
            early = made <= rank
            if early.any():
                # A merge made a pair that ranks before itself. Its piece has to take that pair before
                # its other places of this rank, so it goes alone.
                odd.update((np.searchsorted(ends, touched[early], "right")).tolist())
                made, touched = made[~early], touched[~early]
            if len(made):
                index(made, touched)
    alive = symbol[:n] >= 0
    count = np.add.reduceat(alive, starts)
    ids = symbol[:n][alive].astype(np.uint32).tobytes()
    cuts = (4 * np.append(0, np.cumsum(count))).tolist()
    out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
    for i in odd:
        out[i] = np.array(merge_alone(pieces[i], merges), np.uint32).tobytes()
    return out


def merge_alone(piece: bytes, merges: Merges) -> list[int]:
    """Token ids of one piece: always the pair of least rank, the leftmost of equals."""
    ranks = merges.ranks
    part = [piece[i : i + 1] for i in range(len(piece))]
    after, before = [*range(1, len(part)), -1], [*range(-1, len(part) - 1)]
    heap = [(rank, i) for i in range(len(part) - 1) if (rank := ranks.get(part[i] + part[i + 1])) is not None]
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if not part[i] or j < 0 or ranks.get(part[i] + part[j]) != rank:
            continue
        part[i], part[j] = part[i] + part[j], b""
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for p in (before[i], i):
            if p >= 0 and after[p] >= 0 and (made := ranks.get(part[p] + part[after[p]])) is not None:
                heappush(heap, (made, p))
    return [ranks[p] for p in part if p]


class Encoder:
    """Encodes texts of one worker; holds the rank table and the units seen so far."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(load_ranks(path))
        self.pieces = regex.compile(pattern).findall
        self.cache = UnitCache(self._units)

    def _units(self, texts: list[str]) -> Iterator[bytes]:
        split = [[p.encode() for p in self.pieces(text)] for text in texts]
        ranks = self.merges.ranks
        made: dict[bytes, bytes] = {}
        todo = []
        for piece in {p for parts in split for p in parts}:
            rank = ranks.get(piece)
            if rank is None:
                todo.append(piece)
            else:
                made[piece] = rank.to_bytes(4, "little")
        for at in range(0, len(todo), BLOCK):
            block = todo[at : at + BLOCK]
            made.update(zip(block, replay(block, self.merges), strict=True))
        return (b"".join([made[p] for p in parts]) for parts in split)


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=1)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def _schema(docs: DataFrame, id_col: str, **more: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *(T.StructField(n, t) for n, t in more.items())])


def _id_lists(batch: pa.RecordBatch, ranks: str, pattern: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """Ids (first column) and id bytes of portions of a batch (id, text)."""
    cache = _encoder(ranks, pattern).cache
    texts = [t or "" for t in batch.column(1).to_pylist()]
    for start, end in portions(texts):
        yield batch.column(0)[start:end], cache.ids(texts[start:end])


def _as_lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _bytes_of(lists: pa.ListArray, ranks: str) -> pa.Array:
    find = _tokens(ranks).__getitem__
    found = [b"".join(map(find, ids.values.to_numpy(zero_copy_only=False).tolist())) if ids.is_valid else b"" for ids in lists]
    return pa.array(found, pa.binary())


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids array<int>): the tokens of each whole text by the rank file ``ranks``.

    ``ranks`` is a path that every executor can open, ``pattern`` the split that goes before the
    merges. No special tokens. One row per input row, in no order; repeated rows and null ids stay.
    A null or empty text has no ids; an empty table gives an empty one. Other columns are not read,
    so their names cannot clash. A text that is one long piece takes n log n steps.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, parts in _id_lists(batch, ranks, pattern):
                yield pa.RecordBatch.from_arrays([names, _as_lists(parts)], [id_col, "ids"])

    return docs.select(id_col, F.col(text_col)).mapInArrow(run, _schema(docs, id_col, ids=T.ArrayType(T.IntegerType())))


def decode(tokens: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(``id_col``, decoded binary): the bytes of the ids joined, one row per input row.

    Null or empty ids give no bytes. An id outside the rank file fails the job.
    """
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _bytes_of(batch.column(1), ranks)], [id_col, "decoded"])

    return tokens.select(id_col, F.col(ids_col)).mapInArrow(run, _schema(tokens, id_col, decoded=T.BinaryType()))


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids, decoded): ``encode``, then ``decode`` of those ids, in one pass over the data."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, parts in _id_lists(batch, ranks, pattern):
                lists = _as_lists(parts)
                yield pa.RecordBatch.from_arrays([names, lists, _bytes_of(lists, ranks)], [id_col, "ids", "decoded"])

    schema = _schema(docs, id_col, ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType())
    return docs.select(id_col, F.col(text_col)).mapInArrow(run, schema)


def digest(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: token count, digest of its ids, digest of the bytes they decode to."""
    return round_trip(docs, ranks, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
