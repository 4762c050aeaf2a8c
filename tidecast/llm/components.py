"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Components of the undirected graph of ``edges``: rows (node, component).

    The component is its smallest node. Nodes may be of any ordered type. Edges with
    a null end and loops are left out, repeated edges count once, and a node without
    an edge to another one has no row. No edges: no rows.

    A large-star step ties the larger neighbours of every node to its smallest
    neighbour, a small-star step does so for the smaller ones; both keep the
    components and shorten all paths, until every edge leads to the smallest node.
    A node's minimum is aggregated before it is joined, so a node that holds a third
    of all edges is split by the partial aggregate and the skew join. Every round is a
    table in the shared folder; the driver sees only a count and a hash sum.
    """
    a, b = F.col(u), F.col(v)
    links = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    links, state = _round(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while state != before and state[0]:
        before = state
        links, state = _round(_small_star(_large_star(links)))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _round(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The written links, and their count and hash sum, taken while they are written."""
    seen = Observation()
    watched = links.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("v", "u")).alias("xor"))
    out = saved(watched, "links")
    return out, (seen.get["n"], seen.get["sum"], seen.get["xor"])


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
