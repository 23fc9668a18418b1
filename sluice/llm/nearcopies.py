"""Near copies at a Jaccard similarity of 0.8 over five-word shingles: SimHash first, an exact set-similarity join for the rest.

Texts get SimHash fingerprints, and multi-index hashing finds those at two bits or fewer; texts verify these links, and what they
connect is one group from then on. Fingerprints do not reach every pair that is similar enough, so the join follows.

Distinct shingles are hashed and ordered: first those that are not known to be frequent, then by hash. Two
texts that are similar enough share one of the first shingles of that order (prefix filter), have sizes
that allow it (length filter) and enough shingles left behind the first shared one (positional filter). Any
order is complete; the frequent ones, counted on a bounded sample, stand last to keep the buckets small.
What passes is held against a parity sketch, which bounds the difference of two sets from below (a folded one
already where members of a bucket meet), and then verified on the whole texts.

Only the groups that links connect are wanted. So each bucket first compares all members with one centre; after
that, all members that are still in different groups are compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.batches import portions, return_memory, small_batches, unused
from sluice.llm.graph import components
from sluice.llm.simhash import fingerprints, shingles
from sluice.llm.simhash import links as fingerprint_links
from sluice.session import cut_lineage, scratch

# Bits of a parity sketch.
SKETCH = 2048
# Words of 64 bits of the folded sketch that each member of a bucket has with it.
FOLDS = 4
# Words of a fingerprint's shingles.
FINGERPRINT_SIZE = 3
# Texts whose shingles tell the frequent ones, about; a shingle of so many sampled texts is frequent. These bounds
# and the length of the list decide about speed only.
SAMPLED = 20_000
OFTEN = 4
FREQUENT = 200_000
# Members of a bucket are dealt into blocks of about this size.
BLOCK = 256
_NO_ID = (1 << 63) - 1

PRINTS = "ord long, key long, same binary, words long, fp long"
FOLDED = [f"f{i}" for i in range(FOLDS)]
SETS = "ord long, key long, n int, sketch binary, prefix array<long>, " + ", ".join(f"{f} long" for f in FOLDED)


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PRINTS.split(", ")]
    for batch in batches:
        texts = batch.column(2).to_pylist()
        for start, end in portions(texts, 1 << 20):
            words = [t.lower().split() for t in texts[start:end]]
            same = pa.array([xxhash.xxh3_128_digest(b" ".join(w)) for w in words], pa.binary())
            found = fingerprints([shingles(t, FINGERPRINT_SIZE) for t in texts[start:end]])
            columns = [*[batch.column(i)[start:end] for i in range(2)], same, pa.array([len(w) for w in words], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.view(np.int64))], names)
    return_memory()


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """Hashes of the different shingles of a text, in order."""
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(s) for s in shingles(text, size)], np.uint64)).view(np.int64)


def parity(hashes: np.ndarray) -> bytes:
    """A bit is set where an odd number of hashes falls on it: sketches of two sets differ in no more bits than the sets in
    members."""
    return np.packbits(np.bincount(hashes.view(np.uint64) % np.uint64(SKETCH), minlength=SKETCH) & 1).tobytes()


def folded(sketch: bytes) -> np.ndarray:
    """A shorter sketch with the same bound: words of the sketch that fall on one another are added bit by bit."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.int64).reshape(-1, FOLDS), axis=0)


def least_shared(n: int, similarity: float) -> int:
    """Least number of shared shingles of a set of ``n`` with any set that is similar enough."""
    return int(np.ceil(similarity * n - 1e-9))


def _shingle_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle_hashes(text, size))], ["shingle"])

    return run


def frequent_shingles(texts: DataFrame, total: int, size: int) -> np.ndarray:
    """Hashes of shingles that many of about ``SAMPLED`` texts hold, in order; ``FREQUENT`` at most."""
    every = max(1, total // SAMPLED)
    drawn = texts.where(F.pmod(F.xxhash64("ord"), F.lit(every)) == 0).select("text")
    counts = drawn.mapInArrow(_shingle_rows(size), "shingle long").groupBy("shingle").count().where(F.col("count") >= OFTEN)
    found = counts.orderBy(F.desc("count"), "shingle").limit(FREQUENT).toArrow()
    return np.sort(found["shingle"].to_numpy())


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _sets(size: int, similarity: float, frequent: np.ndarray):
    """Size, sketch and first shingles of each text."""
    names = [c.split()[0] for c in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sketches, prefixes, folds = [], [], [], []
            for text in batch.column(2).to_pylist():
                found = shingle_hashes(text, size)
                n = len(found)
                late = _within(found, frequent)
                prefixes.append(np.concatenate([found[~late], found[late]])[: n - least_shared(n, similarity) + 1])
                sizes.append(n)
                sketches.append(parity(found))
                folds.append(folded(sketches[-1]))
            columns = [pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            columns += map(pa.array, np.array(folds, np.int64).reshape(-1, FOLDS).T)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)
        return_memory()

    return run


def _enough(m: str, n: str, i: str, j: str, similarity: float) -> Column:
    """Whether sets of ``m`` and ``n`` shingles whose first shared one has places ``i`` and ``j`` can be similar, by
    their folded sketches (the one's columns begin with ``c``) too."""
    apart = sum((F.bit_count(F.col(f).bitwiseXOR(F.col(f"c{f}"))) for f in FOLDED), F.lit(0))
    shared = F.lit(similarity / (1 + similarity)) * (F.col(m) + F.col(n)) - 1e-6
    most = 1 + F.least(F.col(m) - F.col(i), F.col(n) - F.col(j)) - 1
    close = apart <= (1 - similarity) / (1 + similarity) * (F.col(m) + F.col(n)) + 1e-6
    return (F.least(m, n) >= similarity * F.greatest(m, n) - 1e-6) & (most >= shared) & close


def _sketch_filter(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s, t = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (4, 5))
            apart = np.bitwise_count(s ^ t).sum(1, dtype=np.int64)
            most = (1 - similarity) / (1 + similarity) * (batch.column(2).to_numpy() + batch.column(3).to_numpy()) + 1e-6
            yield batch.select(["x", "y"]).filter(pa.array(apart <= most))

    return run


def _similar(size: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = set(shingles(s, size)), set(shingles(t, size))
                both = len(a & b)
                keep.append(both >= similarity * (len(a) + len(b) - both))
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))
        return_memory()

    return run


def _by_fingerprint(kinds: DataFrame) -> DataFrame:
    """(x, y): texts whose fingerprints are equal or at two bits or fewer, by the least text of each fingerprint.

    All texts of a fingerprint meet its least one, and the least ones of linked fingerprints each other.
    """
    firsts = cut_lineage(kinds.groupBy("fp").agg(F.min("ord").alias("first"), F.count("*").alias("texts")))
    same = kinds.join(firsts.where("texts > 1"), "fp").where("ord <> first").select(F.col("first").alias("x"), F.col("ord").alias("y"))
    linked = fingerprint_links(firsts.select("fp")).join(firsts.select(F.col("fp").alias("a"), F.col("first").alias("p")), "a")
    linked = linked.join(firsts.select(F.col("fp").alias("b"), F.col("first").alias("q")), "b")
    return same.unionAll(linked.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y"))).distinct()


def _named(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the group of each so far as ``root``."""
    roots = components(links, "x", "y").toDF("ord", "named")
    return members.drop("root").join(roots, "ord", "left").withColumn("root", F.coalesce("named", "ord")).drop("named")


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the group of each so far, in buckets that hold several groups."""
    named = _named(members, links)
    open_ = named.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("bucket")
    return cut_lineage(named.join(open_, "bucket", "left_semi"))


def _with_centre(members: DataFrame, similarity: float) -> DataFrame:
    """(x, y): each member of a bucket and the bucket's centre, the text whose shingles most others hold."""
    centres = members.groupBy("bucket").agg(
        F.max(F.struct("reach", (-F.col("ord")).alias("minus"), F.col("n").alias("m"), F.col("at").alias("i"), F.col("root").alias("top"), *FOLDED)).alias("c")
    )
    folds = [F.col(f"c.{f}").alias(f"c{f}") for f in FOLDED]
    pairs = members.join(centres.select("bucket", (-F.col("c.minus")).alias("first"), "c.m", "c.i", "c.top", *folds), "bucket")
    pairs = pairs.where("root <> top").where(_enough("m", "n", "i", "at", similarity))
    return pairs.select(F.least("first", "ord").alias("x"), F.greatest("first", "ord").alias("y")).distinct()


def _all_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(x, y): all members of a bucket that are in different groups.

    Those outside the group of the centre meet all others; a large bucket is many blocks.
    """
    main = F.max_by("root", F.struct("reach", (-F.col("ord")).alias("minus"))).alias("main")
    blocks = members.groupBy("bucket").agg(main, F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = members.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("ord"), F.col("blocks")).cast("int"))
    outside = dealt.where("root <> main").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    folds = [F.col(f).alias(f"c{f}") for f in FOLDED]
    outside = outside.select("bucket", "block", F.col("ord").alias("first"), F.col("n").alias("m"), F.col("at").alias("i"), F.col("root").alias("top"), *folds)
    pairs = dealt.join(outside, ["bucket", "block"]).where("root <> top").where(_enough("n", "m", "at", "i", similarity))
    return pairs.select(F.least("first", "ord").alias("x"), F.greatest("first", "ord").alias("y")).distinct()


def groups(kinds: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """(node, root): texts of ``kinds`` (ord, key, fp) with a near copy, and the least ord of their group.

    ``docs`` (ord, key, text) holds the text of each. The groups are those of all links at ``similarity`` or more.
    """
    frequent = frequent_shingles(docs, docs.count(), size)
    # The texts themselves do not move.
    sets = docs.select("ord", "key", "text").mapInArrow(_sets(size, similarity, frequent), SETS)
    sets = cut_lineage(sets.join(kinds.select("ord", "key"), ["ord", "key"], "left_semi").dropDuplicates(["ord", "key"]))
    keyed = sets.select("ord", "n", F.posexplode("prefix").alias("at", "bucket"))
    shared = keyed.withColumn("held", F.count("*").over(Window.partitionBy("bucket"))).where("held > 1").drop("held")
    shared = cut_lineage(shared)

    def verified(pairs: DataFrame) -> DataFrame:
        prints = sets.select("ord", "n", "sketch")
        near = pairs.join(prints.toDF("x", "m", "s"), "x").join(prints.toDF("y", "n", "t"), "y")
        near = cut_lineage(near.select("x", "y", "m", "n", "s", "t").mapInArrow(_sketch_filter(similarity), "x long, y long"))
        wanted = cut_lineage(near.select(F.col("x").alias("ord")).union(near.select("y")).distinct())
        # Few texts are wanted: they are picked by id before anything moves.
        held = docs.join(wanted, "ord", "left_semi").join(kinds.select("ord", "key"), ["ord", "key"], "left_semi")
        held = cut_lineage(held.groupBy("ord").agg(F.min("text").alias("text")))
        both = near.join(held.toDF("x", "s"), "x").join(held.toDF("y", "t"), "y").select("x", "y", "s", "t")
        return cut_lineage(both.mapInArrow(_similar(size, similarity), "x long, y long"))

    links = verified(_by_fingerprint(kinds))
    reach = shared.groupBy("ord").agg(F.count("*").alias("reach"))
    members = shared.join(reach.join(sets.select("ord", *FOLDED), "ord"), "ord")
    members = cut_lineage(_named(members, links))
    links = links.unionAll(verified(_with_centre(members, similarity)))
    links = links.unionAll(verified(_all_pairs(_open(members, links), similarity)))
    return components(links, "x", "y")


def drop_near_copies(
    docs: DataFrame, size: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs``, all columns, with one document of each group of exact and near copies: the one of least id.

    Exact copies have the same words in the same order, A-Z in either case. Near copies share ``similarity`` of
    their ``size``-word shingles; groups are what such links connect. Texts without words (null ones too)
    are copies of each other. A null id counts as the largest. Of repeated rows one stays.
    """
    small_batches(docs.sparkSession)
    ord_ = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    key = F.xxhash64(text_col)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    read = docs.select(ord_.alias("ord"), key.alias("key"), text.alias("text"))
    by = [unused(docs.columns, "_ord"), unused(docs.columns, "_key")]
    # Only the rows that stay are read later; all else that was staged goes.
    with scratch(docs.sparkSession):
        prints = cut_lineage(read.mapInArrow(_print, PRINTS))
        # Texts of one class are told apart by id; the few rows that repeat an id count as their least key.
        first = F.min(F.struct("ord", "key", "fp")).alias("first")
        kinds = prints.groupBy("same").agg(first, F.first("words").alias("words"))
        kinds = cut_lineage(kinds.select("same", "first.ord", "first.key", "first.fp", "words"))
        roots = groups(kinds.where("words > 0"), read, size, similarity).where("node <> root")

        named = kinds.join(roots, kinds["ord"] == roots["node"], "left_anti").select("ord", "key")
        named = cut_lineage(named.distinct(), keep=True)
        again = prints.groupBy("ord", "key").count().where("count > 1").select("ord", "key").join(named, ["ord", "key"], "left_semi")
        again = cut_lineage(again, keep=True).toDF(*by)
    placed = docs.withColumns(dict(zip(by, (ord_, key), strict=True)))
    kept = placed.join(named.toDF(*by), by, "left_semi").drop(*by)
    if again.isEmpty():
        return kept
    once = placed.join(named.toDF(*by), by, "left_semi")
    alone = once.join(again, by, "left_anti").drop(*by)
    repeated = once.join(again, by, "left_semi").dropDuplicates(by).drop(*by)
    return alone.unionByName(repeated)
