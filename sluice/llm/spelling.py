"""Spelling variants: words one edit apart, found by walking a trie that is a table.

Words stand in two tries, forwards and backwards. One edit leaves the first half or the last half of a word
as it is, so a walk starts at the node of its own first half and edits only behind it; every pair is found in
one of the tries. A walk looks only for words with one more character, or as many and greater in order, so a pair is
found from one of its words. Edges are rows (node, text, what is behind it); a state is (word, position, node, edits). Level by
level the frontier of states without an edit is joined with the edges on the node. A node is the hash of its prefix,
so a state that spends its edit goes on to its last node at once: the edge's prefix and the rest of the word. Where an edge
has few words behind it, their ends stand in its row and decide there; otherwise the last node is looked up among the
words, if the next two characters are behind the edge at all. Chains without branches are one edge, so a very long word
takes few levels.

Batches of sorted words make their edges alone: each word is a whole path of its batch, so edges need no other
order, and a colliding hash only adds candidates, which the last comparison drops.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from os.path import commonprefix

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import portions, small_batches
from sluice.session import cut_lineage

LEAST_LENGTH = 7
LEAST_COUNT = 2
# One run of so many loses a code point, and a form stands at least so many times as often as its variant.
DAMAGED = 31
FACTOR = 10
# An edge with so many words behind it or fewer holds their ends.
FEW = 512
# What parts the ends in an edge; no word holds it.
GAP = "|"
# Words a task counts before it sends them on.
HELD = 200_000

SEED = 42


def damaged(doc_id: str, run: str) -> str:
    """The run, without one code point if the hash of document and run asks for it."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least 7 code points that stand twice or more in all texts.

    Tasks add up their own counts before the shuffle, so a word that is everywhere moves once for each.
    """
    small_batches(docs.sparkSession)
    runs = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> Iterator[pa.RecordBatch]:
            words = list(counts)
            for start in range(0, len(words), 20_000):
                part = words[start : start + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[w] for w in part], pa.int64())], ["word", "n"])
            counts.clear()

        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # Lower-casing bytes touches A-Z alone.
                text = (text.as_py() or b"").lower().decode("utf-8", "replace")
                name = "" if own is None else own
                for word, n in Counter(runs.findall(text)).items():
                    word = damaged(name, word)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield from flush()
        yield from flush()

    counted = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def oriented(words: DataFrame) -> DataFrame:
    """(path): every word forwards behind '<' and backwards behind '>'."""
    return words.select(
        F.explode(F.array(F.concat(F.lit("<"), "word"), F.concat(F.lit(">"), F.reverse("word")))).alias("path")
    )


def _node(path: str, depth: int) -> int:
    h = xxhash.xxh64_intdigest(path[:depth].encode(), SEED)
    return h - (1 << 64) if h >> 63 else h


def _below(paths: list[str], depth: int, few: int) -> Iterator[tuple[int, str, int, bool, bool, str]]:
    """Edges of the trie of sorted paths that share their first ``depth`` characters, from there on.

    An edge is (node, to, cut, ends, inner, behind) and leads from the prefix of ``cut`` characters. An inner one leads to
    the prefix ``to``, where a path may end, and to the next two characters ``behind`` it (one, where a path ends then). Another one stands for the few paths
    that go on with the last character of ``to``: ``behind`` are their ends from the cut on.
    """
    todo = [(paths, depth)]
    while todo:
        held, cut = todo.pop()
        node = _node(held[0], cut)
        for first, same in groupby(held, key=lambda path: path[cut : cut + 1]):
            group = list(same)
            if not first:
                # The path that ends at the node itself: walks that start here are longer.
                continue
            if len(group) <= few:
                ends = GAP.join(path[cut:] for path in group)
                yield node, held[0][:cut] + first, cut, False, False, f"{GAP}{ends}{GAP}"
                continue
            # In sorted paths the first and the last share the least.
            shared = len(commonprefix((group[0], group[-1])))
            further = [path for path in group if len(path) > shared]
            pairs = GAP.join(sorted({path[shared : shared + 2] for path in further}))
            yield node, group[0][:shared], cut, len(group[0]) == shared, True, f"{GAP}{pairs}{GAP}"
            if further:
                todo.append((further, shared))


def batch_edges(paths: list[str], few: int = FEW) -> Iterator[tuple[int, str, int, bool, bool, str]]:
    """Edges for all walks to the sorted paths: from the halves of a path and of paths one shorter."""
    starts: dict[str, list[str]] = {}
    for path in paths:
        size = len(path) - 1
        for half in {(size - 1) // 2, size // 2}:
            starts.setdefault(path[: half + 1], []).append(path)
    for prefix, held in starts.items():
        yield from _below(held, len(prefix), few)


def edges(paths: DataFrame, few: int = FEW) -> DataFrame:
    """(node, to, cut, ends, inner, behind) over all paths, from batches of sorted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).to_pylist()
            for a, b in portions(held, 1 << 20):
                part = list(zip(*batch_edges(held[a:b], few), strict=True))
                if part:
                    types = (pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(part, types, strict=True)], ["node", "to", "cut", "ends", "inner", "behind"]
                    )

    # Ranges of words, so that long prefixes meet in one batch; any other order would be right as well.
    ranged = paths.repartitionByRange("path").sortWithinPartitions("path")
    return ranged.mapInArrow(run, "node long, to string, cut int, ends boolean, inner boolean, behind string")


def _shared(a: Column, b: Column) -> Column:
    """Length of the common prefix, by halving."""
    def longer(known: Column, step: Column) -> Column:
        size = known + step
        same = F.substring(a, F.lit(1), size) == F.substring(b, F.lit(1), size)
        return F.when((size <= F.length(a)) & (size <= F.length(b)) & same, size).otherwise(known)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(29, -1, -1)]), F.lit(0), longer)


def one_edit(a: Column, b: Column) -> Column:
    """Whether the texts, whose lengths differ by one at most, are one edit apart."""
    behind = _shared(a, b) + 1
    skip_a, skip_b = F.when(F.length(a) >= F.length(b), 1).otherwise(0), F.when(F.length(b) >= F.length(a), 1).otherwise(0)
    long = (a != b) & (F.substring(a, behind + skip_a, F.length(a)) == F.substring(b, behind + skip_b, F.length(b)))
    # The distance takes time by the square of the length, whatever its threshold is.
    return F.when((F.length(a) <= 64) & (F.length(b) <= 64), F.levenshtein(a, b, 1) == 1).otherwise(long)


def _tail(text: Column | str, start: Column | int) -> Column:
    """The text behind its first ``start`` characters."""
    return F.substring(text, F.lit(start) + 1, F.length(text))


STATE = "struct<near:string,known:boolean,position:int,ends:string>"


def _state(near: Column | None = None, known: bool = True, position: Column | None = None, ends: Column | None = None) -> Column:
    """A word that is near or, if not ``known``, to be looked up; the place behind a matched text; ends to compare with."""
    parts = {"near": near, "known": F.lit(known), "position": position, "ends": ends}
    return F.struct(*[(F.lit(None) if c is None else c).alias(n) for n, c in parts.items()]).cast(STATE)


def _few_words() -> tuple[Column, list[Column]]:
    """At an edge that holds the ends of its words: whether any may be near, and the states behind it (or NULL)."""
    rest, first, ends = _tail("path", F.col("position")), F.substring("to", F.col("cut") + 1, F.lit(1)), F.col("behind")
    prefix, matched = F.substring("to", F.lit(1), F.col("cut")), F.startswith(rest, first)
    # The word leaves the trie at this very character, so the edit is here: a greater one instead, or one more.
    here = [F.concat(first, _tail(rest, 1)), F.concat(first, rest)]
    among = [there & F.contains(ends, F.concat(F.lit(GAP), text, F.lit(GAP))) for text, there in zip(here, (first > rest, F.lit(True)), strict=True)]
    states = [F.when(~matched & there, _state(F.concat(prefix, text))) for text, there in zip(here, among, strict=True)]
    return matched | among[0] | among[1], [*states, F.when(matched, _state(ends=ends))]


def _inner_edge() -> tuple[Column, list[Column]]:
    """At an inner edge: whether any state may follow, and the states behind it (or NULL)."""
    rest, label = _tail("path", F.col("position")), _tail("to", F.col("cut"))
    size = F.length(label)
    matched = F.startswith(rest, label)

    def left(by: int) -> Column:
        return _tail(rest, size + by)

    def open_(by: int) -> Column:
        """What is left of the word can go on behind the edge."""
        two = F.concat(F.lit(GAP), F.substring(left(by), 1, 2), F.lit(GAP))
        there = F.when(F.length(rest) == size + by, F.col("ends")).otherwise(F.contains(F.col("behind"), two))
        return (F.length(rest) >= size + by) & there

    def edited(by: int) -> Column:
        # Behind a matched text the first difference, and so the edit, comes later.
        start = F.substring(rest, F.lit(1), size + by)
        fits = ~matched & open_(by) & (F.lit(by < 0) | (label > start)) & one_edit(start, label)
        return F.when(fits, _state(F.concat(F.col("to"), left(by)), known=False))

    possible = matched | open_(0) | open_(-1)
    return possible, [edited(0), edited(-1), F.when(matched, _state(position=F.col("position") + size))]


def _advance(frontier: DataFrame, table: DataFrame) -> DataFrame:
    """One level: (path, to, near, known, position) behind the edges of the frontier's nodes.

    Up to three states stand in an array of fixed size, and ends are compared as rows, so all of it compiles.
    """
    (near, few), (further, many) = _few_words(), _inner_edge()
    states = F.array(*[F.when(F.col("inner"), a).otherwise(b) for a, b in zip(many, few, strict=True)])
    met = frontier.join(table, "node").where(F.when(F.col("inner"), further).otherwise(near))
    rows = met.select("path", F.col("position").alias("at"), "to", "cut", F.explode(states).alias("s")).where(F.col("s").isNotNull())
    rows = rows.select("path", "to", "cut", "s.*", _tail("path", F.col("at")).alias("rest"))
    half = F.ceil(F.length("rest") / 2).cast("int")
    rows = rows.select("*", F.substring("rest", F.lit(1), half).alias("head"), _tail("rest", half).alias("foot"))
    rows = rows.select("*", F.explode_outer(F.split("ends", r"\|")).alias("end"))
    end, rest = F.col("end"), F.col("rest")
    # One edit leaves either half of the rest as it is, which most ends have not; these need no distance.
    alike = F.startswith(end, F.col("head")) | F.endswith(end, F.col("foot"))
    more = F.length(end) - F.length(rest)
    close = (end != "") & alike & ((more == 1) | ((more == 0) & (end > rest))) & one_edit(end, rest)
    found = F.when(F.col("end").isNull(), F.col("near")).otherwise(F.concat(F.substring("to", F.lit(1), F.col("cut")), F.col("end")))
    return rows.where(F.col("end").isNull() | close).select("path", "to", found.alias("near"), "known", "position")


def neighbours(words: DataFrame, few: int = FEW) -> DataFrame:
    """(word, near): all ordered pairs of the given words that differ by exactly one inserted, deleted or replaced code point."""
    paths = cut_lineage(oriented(words))
    table = cut_lineage(edges(paths, few))
    half = F.floor((F.length("path") - 1) / 2).cast("int") + 1
    frontier = paths.select("path", half.alias("position"), F.xxhash64(F.substring("path", F.lit(1), half)).alias("node"))
    certain = asked = None
    while True:
        reached = cut_lineage(_advance(frontier, table))
        hits, open_ = (reached.where(F.col("near").isNotNull() & (F.col("known") == k)).select("path", "near") for k in (True, False))
        certain = hits if certain is None else certain.unionByName(hits)
        asked = open_ if asked is None else asked.unionByName(open_)
        frontier = reached.where(F.col("position").isNotNull()).select("path", "position", F.xxhash64("to").alias("node"))
        if frontier.isEmpty():
            break
    found = certain.unionByName(asked.join(paths.withColumnRenamed("path", "near"), "near", "left_semi").select("path", "near"))

    def word(path: str) -> Column:
        text = _tail(path, 1)
        return F.when(F.startswith(path, F.lit("<")), text).otherwise(F.reverse(text))

    pairs = found.select(word("path").alias("word"), word("near").alias("near"))
    close = F.abs(F.length("word") - F.length("near")) <= 1
    pairs = pairs.where(close & one_edit(F.col("word"), F.col("near"))).distinct()
    both = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms, for every word with a form.

    A form stands ten times as often as its word, so a chain has at most as many links as the largest count has
    digits; pointers double in each round.
    """
    jumps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(jumps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        jumps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return jumps


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of all texts.

    A null or empty text has no words; a null id counts as the empty one; repeated rows count as often as they stand.
    Of near words with equal counts the least in code-point order is the form. Very long texts are read whole, very
    long words move whole. Other columns are not read. An empty table gives no rows.
    """
    words = cut_lineage(word_counts(docs, id_col, text_col))
    pairs = cut_lineage(neighbours(words))
    counted = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form")))
    summed = counted.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(summed, "word", "left")
    often = -F.col("best.order") >= FACTOR * F.col("n")
    formed = cut_lineage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(often, F.col("best.form")).alias("form"), F.when(often, -F.col("best.order")).alias("form_n"),
        )
    )
    rooted = roots(formed.where(F.col("form").isNotNull()))
    return formed.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
