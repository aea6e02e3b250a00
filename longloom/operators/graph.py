"""Directed graphs as edge tables (u, v).

Closures run in rounds: a frontier joins the edges, and an anti-join takes out
what has been visited, so paths that meet count once and cycles end. The
rounds so far are written to a shared folder every few steps, which cuts the
lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import stored
from .neighbors import label_components


def nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v"))


def undirected(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(reversed_edges(edges)).distinct()


def bfs(edges: DataFrame, starts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(start, node, depth): the fewest steps from each start; the start itself at 0."""
    edges = stored(edges.select("u", "v").distinct(), "edges")
    seen = stored(starts.select(F.col("node").alias("start"), "node", F.lit(0).alias("depth")).distinct(), "layer")
    frontier, depth = seen, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        step = frontier.join(edges, frontier["node"] == edges["u"]).select("start", F.col("v").alias("node")).distinct()
        frontier = stored(step.join(seen, ["start", "node"], "left_anti").withColumn("depth", F.lit(depth)), "layer")
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def layer(edges: DataFrame, starts: DataFrame, depth: int) -> DataFrame:
    return bfs(edges, starts, depth).where(F.col("depth") == depth).select("start", "node")


def reachable(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Nodes reached from each start; never the start itself, even on a cycle."""
    return bfs(edges, starts).where("depth > 0").select("start", "node")


def weak_component(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Nodes connected with each start when directions are ignored, itself included.

    By component labels, whose rounds grow with the logarithm of the paths, not with their length.
    """
    of = label_components(edges.select("u", "v"))
    asked = starts.select(F.col("node").alias("start")).distinct().join(of.withColumnRenamed("id", "start"), "start", "left")
    found = asked.join(of.withColumnRenamed("id", "node"), "component_id").select("start", "node")
    return found.unionByName(asked.where("component_id IS NULL").select("start", F.col("start").alias("node")))


def shortest_path(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """(src, dst, length) for the pairs; null where there is no path."""
    found = bfs(edges, pairs.select(F.col("src").alias("node")))
    return pairs.join(found.select(F.col("start").alias("src"), F.col("node").alias("dst"), F.col("depth").alias("length")), ["src", "dst"], "left")


def peel(edges: DataFrame, group: list[str] | None = None) -> DataFrame:
    """The edges that stay when nodes without incoming edges are taken away again and again: those behind a cycle."""
    keys = group or []
    rest = stored(edges.select(*keys, "u", "v").distinct(), "peel")
    n = rest.count()
    while n:
        rest = stored(rest.join(rest.select(*keys, F.col("v").alias("u")).distinct(), [*keys, "u"], "left_semi"), "peel")
        n, before = rest.count(), n
        if n == before:
            break
    return rest


def has_cycle(edges: DataFrame) -> DataFrame:
    return peel(edges).agg((F.count("*") > 0).alias("has_cycle"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, out_degree, in_degree, degree)."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i"))
    )
    return ends.groupBy("node").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.count("*").alias("degree")
    )


def max_degree(edges: DataFrame) -> DataFrame:
    """All nodes of the highest total degree."""
    d = degrees(edges)
    return d.join(d.agg(F.max("degree").alias("degree")), "degree", "left_semi").select("node", "degree")
