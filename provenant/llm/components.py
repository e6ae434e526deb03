"""Connected components of a table of edges, by alternating large-star and small-star."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provenant.llm.common import drop_written, written

#: Edges that a task contracts at a time before the first shuffle (4 MB of node numbers).
PART_EDGES = 1 << 18


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges, in order, and the smallest node that they connect it with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends.reshape(2, -1)
    label = np.arange(len(nodes))  # the numbers stand in the order of the nodes
    while True:
        p, q = label[x], label[y]
        open_ = p != q
        if not open_.any():
            return nodes, nodes[label]
        x, y, p, q = x[open_], y[open_], p[open_], q[open_]
        np.minimum.at(label, np.maximum(p, q), np.minimum(p, q))
        while (label[label] != label).any():
            label = label[label]


def contracted_parts(edges: DataFrame, part_edges: int) -> DataFrame:
    """Edges (a, b) with the same components: stars of each ``part_edges`` edges, as they lie, without a shuffle.

    A node that stands alone keeps its edge to itself.
    """

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            columns = (np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for batch in held]) for c in (0, 1))
            return pa.RecordBatch.from_arrays(list(map(pa.array, stars(*columns))), ["a", "b"])

        for batch in batches:
            for at in range(0, len(batch), part_edges):
                piece = batch.slice(at, part_edges)
                if n and n + len(piece) > part_edges:
                    yield flush()
                    held, n = [], 0
                held.append(piece)
                n += len(piece)
        if n:
            yield flush()

    return edges.select(F.col("a").cast("long"), F.col("b").cast("long")).mapInArrow(contract, "a long, b long")

def contracted(edges: DataFrame) -> DataFrame:
    """Edges with the same components, mostly far fewer: a node's smaller neighbours are tied to the smallest of them.

    Nodes that share neighbours thus lead to the same few edges between those.
    """
    low = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = low.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = low.filter("a <> b").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(rest).distinct()


def jumped(edges: DataFrame) -> DataFrame:
    """Edges with the same components: the smaller end of each, ``b``, gives way to its own smallest neighbour."""
    least = edges.filter("a <> b").groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
    return edges.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def unfinished(edges: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or one on either side; without, each component is a star."""
    proper = edges.filter("a <> b")
    ends = proper.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(proper.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 or up = 1 and down = 1").limit(1).count() > 0


def connected(spark: SparkSession, edges: DataFrame, part_edges: int = PART_EDGES) -> DataFrame:
    """(node, label) for every node of ``edges`` (a long, b long): label is the smallest node reachable.

    Tasks first contract ``part_edges`` edges at a time where they lie (:func:`contracted_parts`); edges that are one such
    part are done then. Otherwise rounds of large-star (:func:`jumped`) and small-star (:func:`contracted`) follow, as of
    Kiveris et al. 2014, until every component is a star around its smallest node: there is no other end. A path of 3,000
    nodes in any order takes about ten. Each round's result is a written table. An edge from a node to itself makes the
    node known. ``edges`` is read twice.
    """
    parts = max(1, -(-edges.count() // part_edges))
    edges = contracted_parts(edges.coalesce(parts), part_edges)
    if parts == 1:
        return written(spark, edges.toDF("node", "label"))
    edges = written(spark, contracted(contracted(edges)))
    while unfinished(edges):
        step = written(spark, contracted(jumped(edges)))
        drop_written(spark, edges)
        edges = step
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    leaves = edges.filter("a <> b").select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = written(spark, leaves.unionByName(centres))
    drop_written(spark, edges)
    return labels
