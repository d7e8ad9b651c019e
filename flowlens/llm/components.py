"""Connected components of a graph held as a table of edges.

Alternating large-star and small-star steps: every node sends its larger neighbours to the
smallest node it knows, then its smaller ones, until each component is a star around its
smallest node.  Edges stay about as many as at first and the number of rounds grows with the
logarithm of the component's size.  Each round is written to the shared checkpoint folder, and
so are the minima of each step, so that both sides of a join are plain exchanges and Spark can
split a node that a large part of the edges meets.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.base import settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge to another; ``root`` is the smallest node of
    its component.  Null ends and edges from a node to itself are ignored."""
    now = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m")))
        large = settle(both.join(least, F.col("u") == F.col("w")).where(F.col("v") > F.col("u"))
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())
        least = settle(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")))
        small = (large.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        after = settle(small.unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
        was, state, now = state, _state(after), after
        if state == was:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a checksum that does not depend on their order."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
    return tuple(row)


def forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Label of each of n nodes after joining the pairs (a, b): the smallest node it reaches.
    ``label`` continues from an earlier result."""
    label = np.arange(n) if label is None else label
    while True:
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        if (la == lb).all():
            return label
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            to = label[label]
            if (to == label).all():
                break
            label = to
