"""Approximate nearest neighbours by inner product over balanced posting lists.

Centroids are fitted on a bounded sample and linked into a small graph that every task holds in memory.
Each vector goes to the list of its nearest centroid, and near a boundary to several lists; a query scans the
lists whose centroids are not much farther than the nearest one. Long lists are cut into blocks, so
no list is one task, and equal vectors of a block are scored once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage

# Fixed bounds of the index: centroids, sampled vectors for each, replicas of a vector.
LISTS = 4096
PER_LIST = 128
SAMPLE = 32
REPLICAS = 4
# A query scans so many lists at least, however near the first one is.
LEAST = 16
# Lists of a query that are scanned before the others.
NEAREST = 4
# Queries whose exact neighbours choose how many lists are scanned, and the share of neighbours within those lists.
MEASURED = 256
RECALL = 0.98
# A block of a list has about this many vectors.
BLOCK = 2048


@dataclass
class Centroids:
    """Centroids in the space with one more dimension, and their neighbour graph."""

    points: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    norm: float

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Stored vectors with the coordinate that gives all of them one norm: the nearest by distance to
        a query (whose added coordinate is 0) is then the largest by inner product."""
        rest = np.sqrt(np.maximum(self.norm**2 - np.einsum("ij,ij->i", vectors, vectors), 0))
        return np.hstack([vectors, rest[:, None]])

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of about the ``beam`` nearest centroids, by best-first search of the graph."""
        n, k = len(queries), len(self.points)
        beam = min(beam, k)
        rows = np.arange(n)
        square = np.einsum("ij,ij->i", self.points, self.points)
        seen = np.zeros((n, k + 1), bool)
        seen[:, k] = True
        ids = np.full((n, beam), k)
        far = np.full((n, beam), np.inf)
        done = np.ones((n, beam), bool)

        def offer(new: np.ndarray) -> None:
            nonlocal ids, far, done
            fresh = ~np.take_along_axis(seen, new, 1)
            np.put_along_axis(seen, new, True, 1)
            at = np.minimum(new, k - 1)
            gap = square[at] - 2 * np.einsum("ijk,ik->ij", self.points[at], queries)
            all_far = np.hstack([far, np.where(fresh, gap, np.inf)])
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids = np.take_along_axis(np.hstack([ids, new]), best, 1)
            far = np.take_along_axis(all_far, best, 1)
            done = np.take_along_axis(np.hstack([done, ~fresh]), best, 1)

        offer(np.broadcast_to(self.entries, (n, len(self.entries))))
        while not done.all():
            nearest_open = np.argmin(done, axis=1)
            open_ = ~done[rows, nearest_open]
            done[rows, nearest_open] = True
            source = np.where(open_, ids[rows, nearest_open], k)
            offer(self.graph[source])
        gap = far + np.einsum("ij,ij->i", queries, queries)[:, None]
        return ids, np.sqrt(np.maximum(gap, 0))


    def ranked(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of all centroids, nearest first. They are ``LISTS`` at most, so this is one product."""
        gap = np.einsum("ij,ij->i", self.points, self.points) - 2 * queries @ self.points.T
        gap += np.einsum("ij,ij->i", queries, queries)[:, None]
        ids = np.argsort(gap, axis=1, kind="stable")
        return ids, np.sqrt(np.maximum(np.take_along_axis(gap, ids, 1), 0))


def fit(sample: np.ndarray, norm: float, lists: int, rounds: int = 8, degree: int = 16) -> Centroids:
    """Balanced k-means over distinct sampled vectors: the distance to a centroid grows with its size."""
    found = Centroids(np.empty((0, 0)), np.empty((0, 0), int), np.empty(0, int), norm)
    points = np.unique(found.lift(sample), axis=0)
    chance = np.random.default_rng(0)
    k = min(lists, len(points))
    centres = points[chance.choice(len(points), k, replace=False)]
    weight = np.zeros(k)
    for _ in range(rounds):
        owner = np.empty(len(points), int)
        total = 0.0
        for a in range(0, len(points), 4096):
            gap = (centres**2).sum(1) - 2 * points[a : a + 4096] @ centres.T
            owner[a : a + 4096] = np.argmin(gap + weight, axis=1)
            total += (gap.min(1) + (points[a : a + 4096] ** 2).sum(1)).sum()
        size = np.bincount(owner, minlength=k)
        mean = total / len(points)
        weight = 0.3 * mean * (size / max(1.0, len(points) / k) - 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, points)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    degree = min(degree, k)
    graph = np.full((k + 1, degree + 2), k)
    for a in range(0, k, 1024):
        gap = (centres**2).sum(1) - 2 * centres[a : a + 1024] @ centres.T
        graph[a : min(a + 1024, k), :degree] = np.argsort(gap, axis=1)[:, :degree]
    # Two links to far nodes keep the graph in one piece.
    graph[:k, degree] = (np.arange(k) + 1) % k
    graph[:k, degree + 1] = chance.permutation(k)
    return Centroids(centres, graph, np.unique(np.linspace(0, k - 1, min(k, 16)).astype(int)), norm)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assigner(index: Centroids, ratio: float, least: int, most: int, beam: int, lift: bool):
    """A batch function: one output row for each list a vector belongs to, and the list's place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 1024):
                batch = whole.slice(a, 1024)
                vectors = _matrix(batch.column(1))
                if lift:
                    vectors = index.lift(vectors)
                else:
                    vectors = np.hstack([vectors, np.zeros((len(vectors), 1))])
                ids, gap = index.nearest(vectors, max(beam, most)) if lift else index.ranked(vectors)
                take = (gap <= ratio * gap[:, :1] + 1e-9) & (ids < len(index.points))
                take[:, :least] = ids[:, :least] < len(index.points)
                take[:, most:] = False
                row, at = np.nonzero(take)
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(ids[row, at].astype(np.int32)), pa.array(at.astype(np.int32))],
                    ["vec_id", "vector", "list", "place"],
                )

    return run


def _scan(k: int):
    def run(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
        """The ``k`` best of a block for each query, of those that reach its bound; equal vectors are scored once, their least ids win."""
        names = ["query_id", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        if not queries.num_rows or not members.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        q, qid = _matrix(queries["vector"].combine_chunks()), queries["vec_id"].to_numpy()
        bound = queries["bound"].to_numpy()
        v, vid = _matrix(members["vector"].combine_chunks()), members["vec_id"].to_numpy()
        order = np.argsort(vid, kind="stable")
        v, vid = v[order] + 0.0, vid[order]
        kinds_, owner = np.unique(v, axis=0, return_inverse=True)
        by_kind = np.argsort(owner.reshape(-1), kind="stable")
        heads = np.searchsorted(owner.reshape(-1)[by_kind], np.arange(len(kinds_) + 1))
        out: list[tuple] = []
        for a in range(0, len(q), 256):
            rough = q[a : a + 256] @ kinds_.T
            # One more than k: the query itself may be among them.
            edge = -np.partition(-rough, min(k, len(kinds_) - 1), axis=1)[:, min(k, len(kinds_) - 1)]
            edge = np.maximum(edge, bound[a : a + 256])
            slack = 1e-9 * (1 + np.where(np.isfinite(edge), np.abs(edge), 0))
            for i in range(len(rough)):
                near = np.flatnonzero(rough[i] >= edge[i] - slack[i])
                if not len(near):
                    continue
                score = (kinds_[near] * q[a + i]).sum(1)
                ids, scores = [], []
                for j, s in zip(near.tolist(), score.tolist(), strict=True):
                    mine = vid[by_kind[heads[j] : min(heads[j + 1], heads[j] + k + 1)]]
                    mine = mine[mine != qid[a + i]][:k]
                    ids.append(mine)
                    scores.append(np.full(len(mine), s))
                ids, scores = np.concatenate(ids), np.concatenate(scores)
                best = np.lexsort((ids, -scores))[:k]
                out.append((np.full(len(best), qid[a + i]), ids[best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return run


def _best(queries: np.ndarray, qid: np.ndarray, k: int):
    """The ``k`` best vectors of a task for each of a few queries, by brute force."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.empty(0, np.int64), np.empty(0)) for _ in qid]
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                vid, scores = part.column(0).to_numpy(), queries @ _matrix(part.column(1)).T
                scores[qid[:, None] == vid] = -np.inf
                for i, own in enumerate(scores):
                    ids, values = np.append(held[i][0], vid), np.append(held[i][1], own)
                    best = np.argsort(-values, kind="stable")[:k]
                    held[i] = ids[best], values[best]
        for q, (ids, values) in zip(qid.tolist(), held, strict=True):
            some = np.isfinite(values)
            columns = [np.full(some.sum(), q), ids[some], values[some]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["query_id", "vec_id", "score"])

    return run


def probed(rows: DataFrame, asked: DataFrame, postings: DataFrame, index: Centroids, k: int, ratio: float, lists: int) -> tuple[float, int]:
    """Distance ratio and number of lists within which ``RECALL`` of the exact neighbours of some queries lie.

    ``ratio`` and ``lists`` are the least values. ``MEASURED`` queries are held against all vectors; only their neighbours reach the driver.
    """
    drawn = asked.orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(MEASURED).toArrow()
    if not drawn.num_rows:
        return ratio, lists
    queries, qid = _matrix(drawn["vector"].combine_chunks()), drawn["vec_id"].to_numpy()
    found = rows.mapInArrow(_best(queries, qid, k), "query_id long, vec_id long, score double")
    near = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("all"))
    near = near.select("query_id", F.explode("all.vec_id").alias("vec_id"))
    held = near.join(postings.select("vec_id", "list"), "vec_id").groupBy("query_id", "vec_id").agg(F.collect_list("list").alias("lists"))
    ids, gap = index.ranked(np.hstack([queries, np.zeros((len(queries), 1))]))
    place = np.argsort(ids, axis=1)
    row = {q: i for i, q in enumerate(qid.tolist())}
    firsts = [(row[r.query_id], place[row[r.query_id], r.lists].min()) for r in held.collect()]
    if not firsts:
        return ratio, lists
    at, first = np.array(firsts).T
    most = int(np.quantile(first, RECALL, method="higher")) + 1
    far = float(np.quantile(gap[at, first] / np.maximum(gap[at, 0], 1e-12), RECALL, method="higher"))
    return max(ratio, far), max(lists, most)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        .where("vec_id is not null and vector is not null")
        .where(fine)
    )


def search(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    replica_ratio: float = 1.1,
    query_ratio: float = 1.35,
    query_lists: int = 96,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every``, the ``k`` found
    nearest by inner product among all others, ties to the smaller id.

    Vectors (or ids) that are null, zero, hold null or non-finite components, or have another length than
    most, take no part; other columns are not read. Repeated rows of one id count once. The index is
    fitted on ``SAMPLE`` vectors for each of at most ``LISTS`` lists and holds every vector. A query
    scans the lists within ``query_ratio`` of its nearest centroid, ``query_lists`` at most; both grow where
    the exact neighbours of a sample of queries need it. Its ``NEAREST`` lists come first, and others give only what
    reaches the ``k``-th best of these.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("square")
    )
    common = sizes.orderBy(F.desc("n"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == common["d"]).dropDuplicates(["vec_id"])
    lists = min(LISTS, max(1, common["n"] // PER_LIST))
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(lists * SAMPLE).toArrow()
    index = fit(_matrix(drawn["vector"].combine_chunks()), math.sqrt(common["square"]), lists)

    placed = "vec_id long, vector array<double>, list int, place int"
    postings = cut_lineage(rows.mapInArrow(_assigner(index, replica_ratio, 1, REPLICAS, 16, True), placed))
    asked = rows.where(F.col("vec_id") % every == 0)
    if len(index.points) > LEAST:
        query_ratio, query_lists = probed(rows, asked, postings, index, k, query_ratio, query_lists)
    probes = asked.mapInArrow(_assigner(index, query_ratio, LEAST, query_lists, query_lists, False), placed)

    # One row for each list, so never more than LISTS.
    blocks = postings.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = postings.join(blocks, "list").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    members = members.select("list", "block", "vec_id", "vector").groupBy("list", "block")
    probes = probes.join(blocks, "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    probes = cut_lineage(probes.select("list", "block", "vec_id", "vector", "place"))

    def scanned(part: DataFrame) -> DataFrame:
        by = part.select("list", "block", "vec_id", "vector", "bound").groupBy("list", "block")
        return by.cogroup(members).applyInArrow(_scan(k), "query_id long, vec_id long, score double")

    def best_of(found: DataFrame) -> DataFrame:
        hits = F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("s"), "vec_id")))
        return found.groupBy("query_id").agg(F.slice(hits, 1, k).alias("all"))

    # The nearest lists come first: what they hold bounds what a farther one may still add.
    start = cut_lineage(best_of(scanned(probes.where(F.col("place") < NEAREST).withColumn("bound", F.lit(float("-inf"))))))
    bounds = start.select(F.col("query_id").alias("vec_id"), F.when(F.size("all") == k, -F.col("all")[k - 1]["s"]).alias("least"))
    farther = probes.where(F.col("place") >= NEAREST).join(bounds, "vec_id", "left")
    more = scanned(farther.withColumn("bound", F.coalesce("least", F.lit(float("-inf")))))
    held = start.select("query_id", F.inline("all")).select("query_id", "vec_id", (-F.col("s")).alias("score"))
    best = best_of(held.unionAll(more))
    ranked = best.select("query_id", F.posexplode("all").alias("rank", "hit"))
    return ranked.select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", (-F.col("hit.s")).alias("score")
    )
