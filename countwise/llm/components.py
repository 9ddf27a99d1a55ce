"""Connected components of a link table, by alternating large and small stars.

Links never leave the cluster: every step is an aggregate and a join on the
node.  The smallest neighbours are written and read back before the join: few
of them are broadcast, and of many both sides of the join are shuffle stages,
so AQE can split the partition of a node with very many links.  Link tables
are written in as many partitions as their rows need.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countwise.llm.frames import sized, stored

#: Nodes whose smallest neighbours are broadcast: a few MB.
BROADCAST_NODES = 1 << 17


def _with_least(links: DataFrame, least: DataFrame, nodes: int) -> DataFrame:
    return links.join(F.broadcast(least) if nodes <= BROADCAST_NODES else least, "node")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b) but the smallest of each component.

    The component is the smallest node reachable.  Self-links, repeated links
    and links with a null end count for nothing.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "links")
    rows = edges.count()
    while True:
        # Large star: every node hands its larger neighbours to the smallest node around.
        ends = edges.select(F.col("high").alias("node"), "low", F.lit(None).cast("bigint").alias("larger")).union(
            edges.select(F.col("low").alias("node"), "low", "high"))
        # A node is settled if it has a single, smaller neighbour, or larger ones only.
        smaller = F.when(F.col("low") < F.col("node"), F.col("low"))
        least = stored(sized(ends.groupBy("node").agg(
            F.min("low").alias("least"),
            (F.min(smaller).isNull() | ((F.min(smaller) == F.max(smaller)) & F.max("larger").isNull())).alias("settled")), 2 * rows), "star")
        state = least.agg(F.count("*").alias("nodes"), F.count(F.when(~F.col("settled"), 1)).alias("open")).first()
        if not state.open:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).distinct()
        handed = edges.select(F.col("low").alias("node"), "high")
        edges = stored(sized(_with_least(handed, least, state.nodes).select("high", F.col("least").alias("low")), rows), "links")
        # Small star: every node hands its smaller neighbours to the smallest of them.
        least = stored(sized(edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least")), rows), "star")
        moved = _with_least(edges.select(F.col("high").alias("node"), "low"), least, state.nodes).filter("low <> least")
        edges = stored(sized(moved.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
            least.select(F.col("node").alias("high"), F.col("least").alias("low"))), rows), "links")


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each of n nodes' component under links (i, j), within one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return root
        root = new
