"""Connected components of an edge table by alternating stars.

Each round links every neighbour of a node to the least node it sees (first
the larger neighbours, then the smaller ones); the edges turn into stars whose
centre is the component's least node after a logarithmic number of rounds.
Edges never leave the executors; each round is written as Parquet.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, keep


def _forest(batches):
    """Spanning stars of the edges that one task holds (path halving)."""
    parent: dict[int, int] = {}

    def find(x):
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 1 << 18:  # bounded memory: hand on and start anew
            yield _stars(parent, find)
            parent.clear()
    if parent:
        yield _stars(parent, find)


def _stars(parent, find):
    nodes = np.fromiter(parent, np.int64, len(parent))
    roots = np.fromiter((find(x) for x in nodes.tolist()), np.int64, len(nodes))
    other = nodes != roots
    return pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(roots[other])], ["a", "b"])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of *edges* (a long, b long): component
    is the least node reachable. Self links and repeats are harmless; nodes
    without an edge to another node are left out."""
    spark = edges.sparkSession
    current, path = keep(
        edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(_forest, "a long, b long"),
        "components")
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        following, new_path = keep(small, "components")
        discard(spark, path)
        current, path = following, new_path
        # Stars: every node has one centre, and no centre has one itself.
        children = current.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("b"))
        centres = current.select(F.col("b").alias("a")).distinct()
        if children.where("n > 1").isEmpty() and children.join(centres, "a", "left_semi").isEmpty():
            break
    centres = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(centres)
