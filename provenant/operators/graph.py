"""Bounded traversal of an evidence graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Shares in which a node's edges are first cut, so that a node of many edges fills no single task.
SHARES = 64


def capped_edges(edges: DataFrame, fan_out: int) -> DataFrame:
    """At most ``fan_out`` edges of a node, the first by target, with a flag where some were cut.

    Each share of a node's edges keeps its first ones and tells how many it had; the node's window sees only these.
    """
    share = W.partitionBy("src", F.pmod(F.xxhash64("dst"), F.lit(SHARES)))
    kept = edges.withColumn("_n", F.row_number().over(share.orderBy("dst"))).withColumn("_m", F.count("*").over(share)).filter(F.col("_n") <= fan_out)
    node = W.partitionBy("src")
    of_share = F.when(F.col("_n") == 1, F.col("_m")).otherwise(0)  # once for each share
    out = kept.withColumn("truncated", F.sum(of_share).over(node) > fan_out).withColumn("_n", F.row_number().over(node.orderBy("dst")))
    return out.filter(F.col("_n") <= fan_out).drop("_n", "_m")


def bounded(found: DataFrame, nodes: int) -> DataFrame:
    """(root, node, depth, truncated): at most ``nodes`` nodes of a root, the nearest first, then by id; ``truncated`` where
    an edge or a node was cut on the way."""
    w = W.partitionBy("root")
    rows = found.withColumn("_n", F.row_number().over(w.orderBy("depth", "node"))).withColumn("_cut", F.bool_or("truncated").over(w) | (F.count("*").over(w) > nodes))
    return rows.filter(F.col("_n") <= nodes).select("root", "node", "depth", F.col("_cut").alias("truncated"))


def reachable(edges: DataFrame, roots: DataFrame, depth: int, fan_out: int, verified_only: bool = True, nodes: int | None = None) -> DataFrame:
    """(root, node, depth, truncated): nodes within ``depth`` steps, each with its least depth.

    A level at a time: the nodes first reached at a level are joined with the edges, and nodes seen before are
    dropped, so no path is walked twice. Depth and fan-out bound the result. With ``nodes`` a root has so many at most, the
    nearest first, then by id: a level that goes beyond is cut before it is walked on from, and ``truncated`` is then
    that of the root: whether an edge or a node was cut anywhere on its way.
    """
    if verified_only:
        edges = edges.filter("state = 'VERIFIED'")
    edges = capped_edges(edges.select("src", "dst").distinct(), fan_out)
    front = roots.select("root", F.col("root").alias("node"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("truncated"))
    seen, cut = front, []
    for d in range(1, depth + 1):
        step = front.select("root", F.col("node").alias("src")).join(edges, "src")
        step = step.groupBy("root", F.col("dst").alias("node")).agg(F.bool_or("truncated").alias("truncated"))
        front = step.join(seen.select("root", "node"), ["root", "node"], "left_anti").select("root", "node", F.lit(d).cast("long").alias("depth"), "truncated")
        if nodes is not None:
            root = W.partitionBy("root")  # at most nodes times fan_out rows of a root
            rows = front.join(seen.groupBy("root").agg((F.lit(nodes) - F.count("*")).alias("_left")), "root")
            rows = rows.withColumn("_n", F.row_number().over(root.orderBy("node"))).withColumn("_m", F.count("*").over(root))
            cut.append(rows.filter("_m > _left").select("root"))
            front = rows.filter("_n <= _left").select("root", "node", "depth", "truncated")
        seen = seen.unionByName(front)
    if nodes is None:
        return seen
    roots_cut = seen.filter("truncated").select("root")
    for more in cut:
        roots_cut = roots_cut.unionByName(more)
    flagged = roots_cut.distinct().withColumn("_cut", F.lit(True))
    return seen.join(flagged, "root", "left").select("root", "node", "depth", F.coalesce("_cut", F.lit(False)).alias("truncated"))
