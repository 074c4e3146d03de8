"""Distributed connected components of an edge list.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each round links every
neighbour to the smallest node a node sees, until the edges are stars around
the smallest node of every component. A round is a grouped minimum and a join
per star; its edges are checkpointed, and only an edge count and a hash sum
reach the driver.

A node that a large part of the edges share (a star's centre) would put those
rows into one join task. Nodes of degree above ``max(64, edges / 10000)`` are
therefore joined by broadcast: there are at most ``2 * edges / degree``, so at
most 20,000 of them (or ``edges / 32`` while there are under 640,000 edges)
whatever the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoreline.llm.common import materialise

HUB_DEGREE, HUB_SHARE = 64, 10_000


def _stats(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _least(pairs: DataFrame, n: int) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the smallest v of its u."""
    limit = max(HUB_DEGREE, n // HUB_SHARE)
    least = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("d"))
    hubs = least.where(F.col("d") > limit).select("u", F.col("m").alias("hub_m"))
    marked = pairs.join(F.broadcast(hubs), "u", "left")
    far = marked.where("hub_m IS NOT NULL").select("u", "v", F.col("hub_m").alias("m"))
    near = marked.where("hub_m IS NULL").select("u", "v").join(
        least.where(F.col("d") <= limit).select("u", "m"), "u")
    return far.unionByName(near)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge, component being the
    smallest node reachable. Loops, repeated and null-ended edges are allowed
    and change nothing; no edges give no rows."""
    a_, b_ = F.col(a), F.col(b)
    edges = materialise(links.where(a_.isNotNull() & b_.isNotNull() & (a_ != b_))
                        .select(F.greatest(a_, b_).alias("u"), F.least(a_, b_).alias("v")).distinct())
    before = _stats(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour moves to the smallest of u and its neighbours
        edges = materialise(_least(both, 2 * before[0]).where("v > u")
                            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        n = edges.count()
        # small star: the smaller neighbours, and u, move to the smallest of them
        starred = _least(edges, n)
        edges = materialise(starred.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(starred.select("u", F.col("m").alias("v"))).distinct())
        after = _stats(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
