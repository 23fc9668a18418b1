"""Steps whose rows grow with the documents, and the fingerprints of near copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm import gracehash, nearcopies, postings, simhash, suffixes
from tests.llm.helpers import sentences


def test_near_copies_meet_by_fingerprint_first(spark):
    """texts at two bits or fewer are linked by multi-index hashing, whatever the join finds."""
    own = sentences(31, 40, 400)
    texts = dict(enumerate(own)) | {100 + i: t + " end" for i, t in enumerate(own)} | {200: own[0].replace(" ", "\n")}
    prints = {i: int(f) for i, f in zip(texts, simhash.fingerprints([simhash.shingles(t.encode(), 3) for t in texts.values()]), strict=True)}
    kinds = spark.createDataFrame([(i, int(np.uint64(f).astype(np.int64))) for i, f in prints.items()], "ord long, fp long")
    root = {i: i for i in texts}
    for r in sorted(nearcopies._by_fingerprint(kinds).collect()):
        a, b = root[r.x], root[r.y]
        root = {i: min(a, b) if g in (a, b) else g for i, g in root.items()}
    want = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                want = {i: want[a] if g == want[b] else g for i, g in want.items()}
    assert root == want and len(set(root.values())) < len(texts)


def test_shared_passages_make_no_candidates(spark):
    """texts that share a passage and nothing else meet in its bucket; their pairs do not leave it."""
    size, similarity, count = 5, 0.8, 300
    passage = sentences(32, 1, 60)[0]
    rows = [(i, f"{t} {passage}".encode()) for i, t in enumerate(sentences(33, count, 150))]
    rows.append((count, rows[7][1].replace(b" ba", b" ", 1)))
    read = spark.createDataFrame(rows, "ord long, text binary").selectExpr("ord", "0L AS key", "text")
    sets = read.mapInArrow(nearcopies._sets(size, similarity, np.empty(0, np.int64)), nearcopies.SETS)
    keyed = sets.select("ord", "n", F.posexplode("prefix").alias("at", "bucket"), *nearcopies.FOLDED)
    members = keyed.withColumn("root", F.col("ord")).withColumn("reach", F.lit(1))
    pairs = {(r.x, r.y) for r in nearcopies._all_pairs(members, similarity).collect()}
    assert (7, count) in pairs and len(pairs) < 20


def test_folded_sketches_bound_the_difference():
    dice = np.random.default_rng(34)
    for n, m in ((50, 3), (400, 40), (2000, 100)):
        a = np.unique(dice.integers(0, 1 << 62, n))
        b = np.append(a[m:], dice.integers(0, 1 << 62, m // 2))
        s, t = (nearcopies.folded(nearcopies.parity(x)) for x in (a, b))
        assert np.bitwise_count(s ^ t).sum() <= m + m // 2


def test_ranges_of_suffixes_send_a_row_for_each_block():
    """one row for each block of documents, not for each document."""
    grams = np.arange(5, dtype=np.uint32)
    row = lambda docs: (None, np.tile(grams, len(docs)).tobytes(), np.array(docs).tobytes(), np.full(len(docs), 5, np.int32).tobytes(), None)
    rows = [row(list(range(100))), row(list(range(100, 250)))]
    kinds = (pa.int64(), *[pa.binary()] * 4)
    names = [c.split()[0] for c in suffixes.GRAMS.split(", ")][1:]
    table = pa.table([pa.array([0, 0]), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], ["range", *names])
    found = suffixes._shared_grams(4)(table)
    assert found.num_rows == 4
    parts = [suffixes._grams_of_documents(found.filter(pa.compute.equal(found["block"], b))) for b in range(4)]
    got = {p: sorted(np.frombuffer(g, np.uint32).tolist()) for t in parts for p, g in zip(t["part"].to_pylist(), t["grams"].to_pylist(), strict=True)}
    assert got == {i: grams.tolist() for i in range(250)}


def test_a_list_gives_only_what_reaches_the_bound():
    """rows below a query's bound stay in the list; ties with it come out."""
    dice = np.random.default_rng(35)
    vectors = dice.normal(size=(500, 8))
    scores = np.sort((vectors * vectors[0]).sum(1)[1:])
    vector = lambda rows: pa.array([v.tolist() for v in rows], pa.list_(pa.float64()))
    members = pa.table({"vec_id": np.arange(500), "vector": vector(vectors)})
    for bound, count in ((-np.inf, 20), (scores[-3], 3), (scores[-1] + 1, 0)):
        queries = pa.table({"vec_id": np.array([0]), "vector": vector(vectors[:1]), "bound": np.array([bound])})
        found = postings._scan(20)((None,), queries, members)
        assert np.allclose(np.sort(found["score"].to_numpy()), scores[len(scores) - count :])


def test_a_table_lets_go_of_its_texts_before_it_answers(monkeypatch):
    """rows of a bucket come out when its content is gone."""
    made = []

    class Kept(gracehash.Table):
        def __init__(self, limit):
            super().__init__(limit)
            made.append(self)

    class Records:
        fields = [("row", T.LongType()), ("id", T.LongType()), ("rep", T.LongType()), ("n", T.LongType()), ("sha", T.BinaryType()), ("size", T.LongType()), ("body", T.BinaryType())]
        schema = T.StructType([T.StructField(*f) for f in fields])
        columns = schema.names
        mapInArrow = staticmethod(lambda run, schema: run)

    monkeypatch.setattr(gracehash, "Table", Kept)
    pack = zstandard.ZstdCompressor().compress
    rows = [(i, i, i, 1, bytes([i % 3]) * 32, 9, pack(b"text %d" % (i % 3))) for i in range(9)]
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.binary()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], Records.columns)
    found = next(gracehash._through_tables(Records, 1 << 20)(iter([batch])))
    assert not made[0].contents
    assert sorted(zip(found["rep"].to_pylist(), found["keep_id"].to_pylist(), found["group_size"].to_pylist(), strict=True)) == [(i, i % 3, 3) for i in range(9)]
