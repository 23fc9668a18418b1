"""Removes passages that stand in an earlier document, by a distributed merge sort of sparse suffixes.

Every 50-byte string holds one anchor: the place in it whose 20-byte gram has the least hash. Equal strings
have equal anchors, so only the suffixes at anchors (about one byte in sixteen) need to be sorted.

1. Gram hashes are exchanged first. A suffix whose gram stands in one document only goes no further.
2. The others are sorted in each task, front-coded (the length shared with the suffix before, then the rest)
   and exchanged by ranges of the global order, which is gram hash, then bytes.
3. Each range merges its runs, which are decoded as they are read, with a loser tree that keeps, at every node, the
   prefix shared with the last winner. Suffixes are compared by these lengths; bytes are read only where the lengths tie,
   and only behind the known prefix.
4. In the merged order, strings are equal where the shared prefixes reach over them to the right and the
   bytes left of the anchor agree. All but those of the least document id are removed.

What a range finds about documents is sent in one row for each block of them and taken apart once they have met there, so the
rows grow with the documents and not with the ranges that a document meets.

What a task holds several times is sent once, with its least document, so a passage of very many documents
is a few suffixes for each task. No step keeps more than a range or a batch in memory.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.batches import portions, return_memory, small_batches, unused

SPAN = 50
GRAM = 20
OFFSETS = SPAN - GRAM + 1
# Bytes of its gram's hash that stand before a suffix in the global order.
HEAD = 4
# Text of a range of the order, and text whose suffixes a task sorts together.
RANGE_BYTES = 4 << 20
RUN_BYTES = 12 << 20
# Text of a block of documents, of which a task holds the shared grams or the stretches at once.
BLOCK_BYTES = 16 << 20
# Longer texts are cut into parts, so that places within what is hashed together fit 24 bits.
LONG_BYTES = 4 << 20
# Suffixes of a run; a task that has more sends several runs.
RUN_SUFFIXES = 60_000

_LETTER = np.random.default_rng(50).integers(0, 1 << 64, 256, np.uint64)
_FACTORS = np.random.default_rng(20).integers(0, 1 << 63, 5, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 20 bytes from each place on."""
    one = _LETTER[data]
    f = _FACTORS
    two = one[:-1] * f[0] + one[1:]
    four = two[:-2] * f[1] + two[2:]
    eight = four[:-4] * f[2] + four[4:]
    sixteen = eight[:-8] * f[3] + eight[8:]
    n = len(data) - GRAM + 1
    out = sixteen[:n] * f[4] + four[16 : 16 + n]
    out ^= out >> np.uint64(31)
    return out * f[0]


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of the strings within [start, end) of each text in ``data`` (under 16 MB): place, first and
    last start of the strings it stands for, gram hash."""
    none = np.empty(0, np.int64)
    if not len(starts) or len(data) < SPAN:
        return none, none, none, np.empty(0, np.uint64)
    hashes = gram_hashes(data)
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    for width in (1, 2, 4, 8):
        low = np.minimum(low[:-width], low[width:])
    low = np.minimum(low[: -(OFFSETS - 16)], low[OFFSETS - 16 :])
    turn = np.zeros(len(low) + 1, np.int8)
    some = ends - starts >= SPAN
    np.add.at(turn, starts[some], 1)
    np.add.at(turn, ends[some] - SPAN + 1, -1)
    string = np.flatnonzero(np.cumsum(turn[:-1]))
    if not len(string):
        return none, none, none, np.empty(0, np.uint64)
    at = (low[string] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (string[1:] != string[:-1] + 1)))
    last = np.append(first[1:], len(at)) - 1
    return at[first], string[first], string[last], hashes[at[first]]


def _ranges(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of about 1 MB; a very long text, which may share its batch with short ones, is one of its own."""
    start = 0
    for i, text in enumerate(texts):
        if len(text) > LONG_BYTES:
            yield from ((start + a, start + b) for a, b in portions(texts[start:i], 1 << 20))
            yield i, i + 1
            start = i + 1
    yield from ((start + a, start + b) for a, b in portions(texts[start:], 1 << 20))


def text_anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of texts, part by part: text number, place, first and last start in that text, gram hash."""
    for a, b in _ranges(texts):
        if len(texts[a]) > LONG_BYTES:
            # A very long text goes in parts that overlap by one string less a byte.
            step = 2 << 20
            for at in range(0, len(texts[a]) - SPAN + 1, step):
                data = np.frombuffer(texts[a], np.uint8)[at : at + step + SPAN - 1]
                place, lo, hi, gram = anchors(data, np.array([0]), np.array([len(data)]))
                yield np.full(len(place), a), place + at, lo + at, hi + at, gram
            continue
        length = np.fromiter(map(len, texts[a:b]), np.int64, b - a)
        ends = np.cumsum(length)
        starts = ends - length
        place, lo, hi, gram = anchors(np.frombuffer(b"".join(texts[a:b]), np.uint8), starts, ends)
        row = np.searchsorted(ends, place, "right")
        base = starts[row]
        yield row + a, place - base, lo - base, hi - base, gram


def _range_of(gram: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of the order of gram hashes, all equally wide."""
    return ((gram >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _low(gram: np.ndarray) -> np.ndarray:
    return (gram & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _heads(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def _by_document(order: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Distinct values of ``order`` and the bytes of each column for each of them."""
    by = np.argsort(order, kind="stable")
    heads = _heads(order[by])
    bounds = np.append(heads, len(by)).tolist()
    parts = []
    for column in columns:
        raw, width = column[by].tobytes(), column.dtype.itemsize
        parts.append([raw[a * width : b * width] for a, b in zip(bounds, bounds[1:])])
    return order[by][heads], parts


def _block_of(part: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks of documents, dealt by a mixed ``part``: ids may have any pattern."""
    return _range_of(part.astype(np.int64).view(np.uint64) * _FACTORS[0], blocks)


def _in_blocks(part: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each block and the numbers of its rows, which keep their order."""
    block = _block_of(part, blocks)
    by = np.argsort(block, kind="stable")
    heads = _heads(block[by]).tolist()
    for a, b in zip(heads, [*heads[1:], len(by)]):
        yield int(block[by[a]]), by[a:b]


GRAMS = "range long, part long, grams binary, ords binary, counts binary, shared binary"


def _print_grams(ranges: int):
    """Gram hashes of each task's documents, one row for each range; those that the task itself holds in
    two documents are known to be shared, and go on as rows of their documents."""

    def emit(ords: np.ndarray, grams: np.ndarray) -> pa.RecordBatch:
        by = np.lexsort((ords, grams))
        ords, grams = ords[by], grams[by]
        new = np.append(True, (grams[1:] != grams[:-1]) | (ords[1:] != ords[:-1]))[: len(grams)]
        ords, grams = ords[new], grams[new]
        heads = _heads(grams)
        size = np.diff(np.append(heads, len(grams)))
        twice = np.repeat(size > 1, size)
        rows: list[tuple] = []
        held, (parts,) = _by_document(ords[twice], _low(grams[twice]))
        rows += [(int(o) % ranges, int(o), p, None, None, None) for o, p in zip(held.tolist(), parts, strict=True)]
        for kind, values, owner in ((0, grams[~twice], ords[~twice]), (1, grams[heads][size > 1], None)):
            place = _range_of(values, ranges)
            cuts = _heads(place).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(place)]):
                low = _low(values[a:b])
                if kind:
                    rows.append((int(place[a]), None, None, None, None, low.tobytes()))
                    continue
                inside = np.argsort(owner[a:b], kind="stable")
                docs = owner[a:b][inside]
                first = _heads(docs)
                counts = np.diff(np.append(first, len(docs))).astype(np.int32)
                rows.append((int(place[a]), None, low[inside].tobytes(), docs[first].tobytes(), counts.tobytes(), None))
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["range", "part", "grams", "ords", "counts", "shared"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ords, grams, held = [], [], 0
        for batch in batches:
            own, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for row, _, _, _, gram in text_anchors(texts):
                ords.append(own[row])
                grams.append(gram)
            held += sum(map(len, texts))
            if held > RUN_BYTES:
                yield emit(np.concatenate(ords), np.concatenate(grams))
                ords, grams, held = [], [], 0
        if grams:
            yield emit(np.concatenate(ords), np.concatenate(grams))
        ords, grams = [], []
        return_memory()

    return run


SHARED = "block long, parts binary, grams binary"


def _shared_grams(blocks: int):
    """(block, parts, grams): documents and grams of a range, of those grams that stand in more than one task's rows."""

    def run(table: pa.Table) -> pa.Table:
        part, gram = _shared_pairs(table)
        rows = [(block, part[own].tobytes(), gram[own].tobytes()) for block, own in _in_blocks(part, blocks)]
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)], ["block", "parts", "grams"])

    return run


def _shared_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    names, grams = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    values, owners, known = [], [], []
    for ord_, gram, ords, counts, shared in zip(*[table[c].to_pylist() for c in table.column_names[1:]], strict=True):
        if ord_ is not None:
            grams.append(np.frombuffer(gram, np.uint32))
            names.append(np.full(len(grams[-1]), ord_, np.int64))
        elif shared is not None:
            known.append(np.frombuffer(shared, np.uint32))
        else:
            values.append(np.frombuffer(gram, np.uint32))
            owners.append(np.repeat(np.frombuffer(ords, np.int64), np.frombuffer(counts, np.int32)))
    if values:
        value, owner = np.concatenate(values), np.concatenate(owners)
        every = np.sort(np.concatenate([value, *known]))
        heads = _heads(every)
        often = every[heads][np.diff(np.append(heads, len(every))) > 1]
        take = np.isin(value, often)
        names.append(owner[take])
        grams.append(value[take])
    return np.concatenate(names), np.concatenate(grams)


def _grams_of_documents(table: pa.Table) -> pa.Table:
    """(part, grams): all shared grams of each document of a block."""
    part, gram = (np.frombuffer(b"".join(table[c].to_pylist()), k) for c, k in (("parts", np.int64), ("grams", np.uint32)))
    names, (grams,) = _by_document(part, gram)
    return pa.table({"part": pa.array(names, pa.int64()), "grams": pa.array(grams, pa.binary())})


RUNS = "range long, part long, key long, starts binary, ends binary, " + ", ".join(
    f"{c} binary" for c in ("shared", "lengths", "tails", "parts", "ords", "keys", "places", "times", "least", "most", "lefts")
)


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    while a[known] == b[known]:
        known += 1
    return known


def _sort_runs(ranges: int):
    """Front-coded sorted runs of the suffixes whose grams are shared, a row for each range."""
    names = [c.split()[0] for c in RUNS.split(", ")]


    def emit(entries: dict) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        rows, whole, items = [], [], []
        for (suffix, left), places in entries.items():
            least = min(places)[0]
            own: dict[tuple[int, int, int], list[int]] = {}
            for ord_, part, key, place in places:
                if ord_ > least:
                    # The whole stretch stands in an earlier document of this task.
                    whole.append((part, key, place - len(left), place + len(suffix) - HEAD))
                else:
                    # A text that repeats itself sends a suffix once, with all its places.
                    own.setdefault((part, ord_, key), []).append(place)
            items += [(suffix, left, *doc, at) for doc, at in own.items()]
        items.sort()
        head = np.frombuffer(b"".join([i[0][:HEAD] for i in items]), ">u4").astype(np.uint64)
        place = _range_of(head << np.uint64(32), ranges)
        cuts = _heads(place).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(items)]):
            suffixes, lefts, parts, ords, keys, places = zip(*items[a:b])
            shared = [0, *map(shared_prefix, suffixes, suffixes[1:], repeat(0))]
            ints = lambda values, kind: np.array(values, kind).tobytes()
            rows.append((
                int(place[a]), None, None, None, None, bytes(shared), bytes(map(len, suffixes)),
                pack(b"".join([s[n:] for s, n in zip(suffixes, shared, strict=True)])),
                ints(parts, np.int64), ints(ords, np.int64), ints(keys, np.int64),
                ints([p for at in places for p in at], np.int32), ints([len(at) for at in places], np.int32),
                bytes([SPAN + HEAD - len(s) for s in suffixes]), bytes(map(len, lefts)), pack(b"".join(lefts)),
            ))
        if whole:
            found = np.array(whole, np.int64)
            found = found[np.lexsort((found[:, 1], found[:, 0]))]
            heads = np.flatnonzero(np.append(True, (found[1:, :2] != found[:-1, :2]).any(1))).tolist()
            for a, b in zip(heads, [*heads[1:], len(found)]):
                part, key = found[a, 0].item(), found[a, 1].item()
                rows.append((key % ranges, part, key, found[a:b, 2].tobytes(), found[a:b, 3].tobytes(), *[None] * 11))
        kinds = [pa.int64()] * 3 + [pa.binary()] * 13
        columns = zip(*rows, strict=True) if rows else [[]] * 16
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: dict[tuple[bytes, bytes], list] = {}
        held = 0
        for batch in batches:
            parts, ords, keys, texts, own = [batch.column(i).to_pylist() for i in range(5)]
            wanted = [np.frombuffer(grams, np.uint32) for grams in own]
            wanted = np.concatenate([w.astype(np.uint64) | np.uint64(i) << np.uint64(32) for i, w in enumerate(wanted)])
            for row, place, lo, hi, gram in text_anchors(texts):
                take = np.isin(_low(gram).astype(np.uint64) | row.astype(np.uint64) << np.uint64(32), wanted)
                heads = (gram[take] >> np.uint64(32)).astype(">u4").tobytes()
                spots = zip(row[take].tolist(), place[take].tolist(), lo[take].tolist(), hi[take].tolist(), strict=True)
                for n, (r, p, a, b) in enumerate(spots):
                    text = texts[r]
                    pair = (heads[HEAD * n : HEAD * n + HEAD] + text[p : b + SPAN], text[a:p])
                    spot = (ords[r], parts[r], keys[r], p)
                    if pair in entries:
                        entries[pair].append(spot)
                    else:
                        entries[pair] = [spot]
                    held += 1
            if held > RUN_SUFFIXES:
                yield emit(entries)
                entries, held = {}, 0
        if entries:
            yield emit(entries)
        entries.clear()
        return_memory()

    return run


class FrontCoded(Sequence):
    """A front-coded run, decoded in order: only the string last asked for is held, and none before it comes again."""

    def __init__(self, shared: bytes, lengths: bytes, tails: bytes):
        self.shared, self.lengths, self.tails = shared, lengths, tails
        self.read = self.at = 0
        self.last = b""

    def __len__(self) -> int:
        return len(self.lengths)

    def __getitem__(self, place: int) -> bytes:
        while self.read <= place:
            known, length = self.shared[self.read], self.lengths[self.read]
            end = self.at + length - known
            self.last = self.last[:known] + self.tails[self.at : end]
            self.read, self.at = self.read + 1, end
        return self.last


class LoserTree:
    """Merges sorted runs of byte strings whose shared prefixes with the string before are known.

    Each inner node keeps the run that lost there and the prefix its string shares with the last winner. The
    string sharing more with the last winner is the smaller one; bytes are compared only on a tie.
    """

    def __init__(self, runs: Sequence[Sequence[bytes]], shared: Sequence[Sequence[int]]):
        self.runs, self.shared = runs, shared
        self.length = [len(r) for r in runs]
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.at = [0] * self.size
        self.loser = [0] * self.size
        self.prefix = [-1] * self.size

    def _play(self, node: int) -> tuple[int, int]:
        if node >= self.size:
            run = node - self.size
            return run, 0 if run < len(self.runs) and self.length[run] else -1
        (a, m), (b, n) = self._play(2 * node), self._play(2 * node + 1)
        if m == n >= 0:
            x, y = self.runs[a][0], self.runs[b][0]
            known = shared_prefix(x, y, 0)
            if y < x:
                a, b = b, a
            n = known
        elif n > m:
            a, m, b, n = b, n, a, m
        self.loser[node], self.prefix[node] = b, n
        return a, m

    def merge(self) -> tuple[array, array, list[int]]:
        """Run, place in the run, and prefix shared with the string before, of all strings in order."""
        runs, shared, at, loser, prefix, size = self.runs, self.shared, self.at, self.loser, self.prefix, self.size
        length = self.length
        out_run, out_at, out_prefix = array("i"), array("i"), []
        winner, known = self._play(1)
        while known >= 0:
            place = at[winner]
            out_run.append(winner)
            out_at.append(place)
            out_prefix.append(known)
            place += 1
            at[winner] = place
            known = shared[winner][place] if place < length[winner] else -1
            node = (winner + size) >> 1
            while node:
                other = prefix[node]
                if other > known:
                    rival = loser[node]
                    loser[node], prefix[node] = winner, known
                    winner, known = rival, other
                elif other == known and known >= 0:
                    rival = loser[node]
                    x, y = runs[winner][at[winner]], runs[rival][at[rival]]
                    both = shared_prefix(x, y, known)
                    if y[both:] < x[both:]:
                        loser[node] = winner
                        winner = rival
                    prefix[node] = both
                node >>= 1
        return out_run, out_at, out_prefix


def repeats(
    prefix: np.ndarray, least: np.ndarray, most: np.ndarray, lefts: np.ndarray, ends: np.ndarray, ords: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of the merged order whose gram stands in several documents, and for each of them and each offset of
    its anchor in a string: whether that string also stands in a document of smaller order.

    ``prefix`` counts from the string's first byte (of its gram's hash), ``least`` and ``most`` bound the offsets. The
    ``most`` bytes before an anchor, nearest last, end in ``lefts`` at ``ends``.
    """
    gram = np.cumsum(prefix < HEAD + GRAM) - 1
    heads = _heads(gram)
    several = np.minimum.reduceat(ords, heads) < np.maximum.reduceat(ords, heads)
    live = whole = np.flatnonzero(several[gram])
    out = np.zeros((len(whole), OFFSETS), bool)
    place, rank = np.arange(len(whole)), gram[whole]
    for offset in range(OFFSETS):
        keep = most[live] >= offset
        live, place, rank = live[keep], place[keep], rank[keep]
        if not len(live):
            break
        if offset:
            _, rank = np.unique(rank << 8 | lefts[ends[live] - offset], return_inverse=True)
        use = least[live] <= offset
        who = live[use]
        if not len(who):
            continue
        key = rank[use] << 32 | np.cumsum(prefix < HEAD + SPAN - offset)[who]
        by = np.lexsort((ords[who], key))
        heads = _heads(key[by])
        first = np.repeat(ords[who][by][heads], np.diff(np.append(heads, len(by))))
        out[place[use][by], offset] = ords[who][by] > first
    return whole, out


GONE = "block long, parts binary, keys binary, starts binary, ends binary"
_NONE = (np.empty(0, np.int64),) * 4


def _merge_range(blocks: int):
    """(block, parts, keys, starts, ends): stretches of a range's suffixes that stand in an earlier document."""

    def run(table: pa.Table) -> pa.Table:
        found = [_merged(table.filter(table["part"].is_null()).select(table.column_names[5:]))]
        ready = table.filter(table["part"].is_valid()).select(["part", "key", "starts", "ends"])
        if ready.num_rows:
            starts, ends = (np.frombuffer(b"".join(ready[c].to_pylist()), np.int64) for c in ("starts", "ends"))
            n = np.array([len(x) // 8 for x in ready["starts"].to_pylist()])
            found.append((*(np.repeat(ready[c].to_numpy(), n) for c in ("part", "key")), starts, ends))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        rows = [(block, *(_packed(c[own]) for c in columns)) for block, own in _in_blocks(columns[0], blocks)]
        kinds = (pa.int64(), *[pa.binary()] * 4)
        parts = zip(*rows, strict=True) if rows else [[]] * 5
        return_memory()
        return pa.table([pa.array(c, k) for c, k in zip(parts, kinds, strict=True)], [c.split()[0] for c in GONE.split(", ")])

    return run


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _gone_of_documents(table: pa.Table) -> pa.Table:
    """(part, key, starts, ends): all stretches of each document of a block, those that touch as one."""
    unpack = zstandard.ZstdDecompressor().decompress
    part, key, start, end = (np.frombuffer(b"".join(map(unpack, table[c].to_pylist())), np.int64) for c in ("parts", "keys", "starts", "ends"))
    by = np.lexsort((key, part))
    part, key, start, end = part[by], key[by], start[by], end[by]
    heads = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (key[1:] != key[:-1]))).tolist()
    spans = [union(start[a:b], end[a:b]) for a, b in zip(heads, [*heads[1:], len(by)])]
    columns = [pa.array(part[heads]), pa.array(key[heads]), *(pa.array([s[i].tobytes() for s in spans], pa.binary()) for i in (0, 1))]
    return pa.table(columns, ["part", "key", "starts", "ends"])


def _merged(table: pa.Table) -> tuple[np.ndarray, ...]:
    if not table.num_rows:
        return _NONE
    unpack = zstandard.ZstdDecompressor().decompress
    coded = zip(*[table[c].to_pylist() for c in ("shared", "lengths", "tails")], strict=True)
    runs = [FrontCoded(shared, lengths, unpack(tails)) for shared, lengths, tails in coded]
    run, at, prefix = [np.array(a, np.int32) for a in LoserTree(runs, [r.shared for r in runs]).merge()]
    base = np.cumsum([0] + [len(r) for r in runs])
    order = base[run] + at
    del runs
    column = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    most = column("most", np.uint8)
    lefts = np.frombuffer(b"".join(map(unpack, table["lefts"].to_pylist())), np.uint8)
    ends = np.cumsum(most.astype(np.int64))[order]
    live, hit = repeats(prefix, column("least", np.uint8)[order], most[order], lefts, ends, column("ords", np.int64)[order])
    edge = np.zeros((len(hit), 1), bool)
    row, first = np.nonzero(hit & ~np.hstack([edge, hit[:, :-1]]))
    _, last = np.nonzero(hit & ~np.hstack([hit[:, 1:], edge]))
    if not len(row):
        return _NONE
    times = column("times", np.int32).astype(np.int64)
    offset = np.cumsum(times) - times
    # From here on rows are those of the runs, with all places of a text that repeats itself.
    row = order[live[row]]
    n = times[row]
    spot = np.repeat(offset[row] - np.cumsum(n) + n, n) + np.arange(n.sum())
    place = column("places", np.int32)[spot].astype(np.int64)
    row, start, end = np.repeat(row, n), place - np.repeat(last, n), place - np.repeat(first, n) + SPAN
    return column("parts", np.int64)[row], column("keys", np.int64)[row], start, end


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches that the given ones cover; such that touch are one."""
    by = np.argsort(starts, kind="stable")
    starts, reach = starts[by], np.maximum.accumulate(ends[by])
    first = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return starts[first], reach[np.append(first[1:], len(starts)) - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and remaining bytes of each text; the other columns pass."""
    for batch in batches:
        spans, kept = [], []
        for text, key, gone in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            mine = [g for g in gone or () if g["key"] == key]
            if not mine:
                spans.append([])
                kept.append(text)
                continue
            starts, ends = [g["starts"] for g in mine], [g["ends"] for g in mine]
            a, b = union(np.frombuffer(b"".join(starts), np.int64), np.frombuffer(b"".join(ends), np.int64))
            a, b = a.tolist(), b.tolist()
            spans.append([{"start": x, "end": y} for x, y in zip(a, b, strict=True)])
            kept.append(b"".join([text[x:y] for x, y in zip([0, *b], [*a, len(text)], strict=True)]))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [*batch.columns[3:], pa.array(spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[3:], "spans", "kept"])


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, spans (array of start, end in bytes) and kept (binary, what is left).

    A byte is removed if a 50-byte string over it also starts in a document with a smaller id; strings are
    those of the input, and never cross documents. A null text is empty. Null ids count as larger than
    all others, and rows of equal id (repeated ones too) never remove each other's bytes. Columns not named
    are not read.
    """
    return _cut_repeats(docs, id_col, text_col, ()).select(F.col("rest.id").alias(id_col), "n_bytes", "spans", "kept")


def _cut_repeats(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """(n_bytes, rest, spans, kept): ``rest`` has the id and the ``keep`` columns as k_0, k_1, ..."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    text_hash = F.xxhash64(text_col)
    read = docs.select(
        F.coalesce(F.col(id_col).cast("long"), text_hash).alias("part"),
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("ord"),
        F.xxhash64(id_col, text_col).alias("key"),
        text.alias("text"),
        F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)]).alias("rest"),
    )
    total = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges, blocks = max(2 * partitions, -(-total // RANGE_BYTES)), max(partitions, -(-total // BLOCK_BYTES))

    # Documents meet their grams, and later their stretches, by ``part``: both joins read the same columns
    # by the same key, so the texts move once.
    grams = read.where(F.octet_length("text") >= SPAN).select("part", "text").mapInArrow(_print_grams(ranges), GRAMS)
    shared = grams.groupBy("range").applyInArrow(_shared_grams(blocks), SHARED)
    wanted = shared.groupBy("block").applyInArrow(_grams_of_documents, "part long, grams binary")
    runs = read.join(wanted, "part").select("part", "ord", "key", "text", "grams", "rest").mapInArrow(_sort_runs(ranges), RUNS)
    found = runs.groupBy("range").applyInArrow(_merge_range(blocks), GONE)
    found = found.groupBy("block").applyInArrow(_gone_of_documents, "part long, key long, starts binary, ends binary")
    gone = found.groupBy("part").agg(F.collect_list(F.struct("key", "starts", "ends")).alias("gone"))
    ready = read.join(gone, "part", "left").select("text", "key", "gone", F.octet_length("text").cast("long").alias("n_bytes"), "rest", "ord")
    schema = ready.select("n_bytes", "rest", "ord").schema.add("spans", _SPANS).add("kept", "binary")
    return ready.mapInArrow(_cut, schema).drop("ord")


def _whole_characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [b.decode("utf-8", "ignore") for b in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], batch.schema.names)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the bytes that ``find_repeats`` removes.

    A character of which only some bytes go, goes whole. A null text stays null.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    null = unused(docs.columns, "_null")
    marked = docs.withColumn(null, F.col(text_col).isNull())
    left = _cut_repeats(marked, id_col, text_col, (*rest, null)).select("rest", "kept")
    whole = left.mapInArrow(_whole_characters, T.StructType([left.schema["rest"], T.StructField("kept", T.StringType())]))
    columns = {c: F.col(f"rest.k_{i}") for i, c in enumerate(rest)}
    columns |= {id_col: F.col("rest.id"), text_col: F.when(~F.col(f"rest.k_{len(rest)}"), F.col("kept"))}
    return whole.select(*[columns[c].alias(c) for c in docs.columns])


def digest(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes, removed stretches, digest of what is left."""
    return find_repeats(docs).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
