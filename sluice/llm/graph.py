"""Connected components of links by alternating star steps, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage


def _stars(edges: DataFrame, upper_only: bool) -> DataFrame:
    """One star step over (hi, lo) edges: the neighbours of a node join its least one.

    ``upper_only`` moves larger neighbours only (large star); otherwise smaller ones move (small star).
    The minimum is aggregated before the join, so a node with very many links is no single task.
    """
    if upper_only:
        links = edges.select(F.col("hi").alias("node"), F.col("lo").alias("peer")).unionAll(
            edges.select(F.col("lo").alias("node"), F.col("hi").alias("peer"))
        )
    else:
        links = edges.select(F.col("hi").alias("node"), F.col("lo").alias("peer"))
    least = links.groupBy("node").agg(F.min("peer").alias("least"))
    least = least.select("node", F.least("least", "node").alias("least"))
    joined = links.join(least, "node")
    if upper_only:
        moved = joined.where("peer > node").select(F.col("peer").alias("hi"), F.col("least").alias("lo"))
    else:
        moved = joined.where("peer > least").select(F.col("peer").alias("hi"), F.col("least").alias("lo")).unionAll(
            least.select(F.col("node").alias("hi"), F.col("least").alias("lo"))
        )
    return moved.where("hi <> lo").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node with a link to another node, the least node it can reach.

    Large and small stars alternate until nothing moves, in a number of rounds that grows with the
    logarithm of the nodes. Each round is written to the shared folder, so a lost executor costs one
    round at most, and only a count and a checksum reach the driver. Links with a null end are left out.
    """
    edges = cut_lineage(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    seen = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = mark
        edges = cut_lineage(_stars(_stars(edges, True), False))
