"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import cut_lineage


#: Counted links that a single task may join up; more are contracted by all tasks, in rounds.
ONE_TASK_LINKS = 500_000


def smallest_reachable(v: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each is linked to, directly or not."""
    nodes, at = np.unique(np.concatenate([v, u]), return_inverse=True)
    a, b = at[: len(v)], at[len(v) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)  # roots are moved too, so that paths shrink by jumps
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return nodes, nodes[label]


def _join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [b for b in batches if len(b)]
    if parts:
        whole = pd.concat(parts)
        node, label = smallest_reachable(whole["v"].to_numpy(), whole["u"].to_numpy())
        yield pd.DataFrame({"node": node, "label": label})


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, or to the node itself."""
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("w"), F.least("v", "m").alias("m"))
    return both.where("u > v").join(least, F.col("v") == F.col("w")).select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest neighbour."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    moved = edges.join(least.withColumnRenamed("v", "w"), F.col("v") == F.col("w")).where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.unionByName(least.select("v", F.col("m").alias("u"))).distinct()


def components(links: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """``node, label`` for all nodes of the links ``a, b``: the label is the smallest node that can be reached.

    Links may be given in any direction, repeatedly, and from a node to itself. Their distinct pairs are stored
    and counted; up to ``one_task_links`` of them are joined up by one task. More are contracted in rounds that
    shuffle the links and write them to the shared folder, so that a lost executor costs a re-read; a node's
    many links are combined before they are shuffled, and the joins are split by adaptive execution. Both ways
    give the same rows.
    """
    ends = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    alone = ends.where("u = v").select("v").distinct()
    edges = cut_lineage(ends.where("u < v").distinct())
    seen = _checksum(edges)
    if seen[0] <= one_task_links:
        joined = edges.repartition(1).mapInPandas(_join_up, "node long, label long")
        return joined.unionByName(alone.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("label")))
    return nodes.unionByName(alone.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
