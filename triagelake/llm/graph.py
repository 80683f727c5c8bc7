"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.session import materialise

#: A node with more than one part in so many of the rows is heavy; there are fewer such nodes than this.
PARTS = 128


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the pairs (i, j) connect."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        for ends in (i, j, label[i], label[j]):
            np.minimum.at(label, ends, low)
        while not np.array_equal(label, jumped := label[label]):
            label = jumped
        if np.array_equal(before, label):
            break
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def stars(ends: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """``ends`` (u, v) of that many rows with m, the least v of its u; and (u, m) alone.

    The least v of a heavy node is sent to its rows, which stay where they are: no task receives more
    than a part of the rows for one node. What is sent has less than ``PARTS`` rows at every size.
    """
    low = ends.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    is_heavy = F.col("n") * PARTS > rows
    heavy = F.broadcast(low.where(is_heavy).select("u", F.col("m").alias("sent")))
    known = ends.join(heavy, "u", "left")
    moved = known.where("sent IS NULL").select("u", "v").join(low.where(~is_heavy).select("u", "m"), "u")
    stayed = known.where("sent IS NOT NULL").select("u", "v", F.col("sent").alias("m"))
    return stayed.unionByName(moved), low.select("u", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node reachable, for every node of ``edges`` (u, v) but
    those that are their own label.

    Alternating stars: every node links its larger neighbours to its smallest one, then its
    smaller neighbours and itself to the smallest. Work and storage stay in proportion to the
    edges in every round, a node's neighbours are only counted into a minimum, never gathered, nor
    do those of the smallest node of a large component meet in one task (``stars``), and
    each round is a written table, so that a lost executor repeats one round at most. Repeated edges count
    once; without edges the table is empty.
    """
    edges = (
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges = materialise(edges)
    seen = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == seen or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near, _ = stars(both, 2 * state["n"])
        large = near.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        near, low = stars(large, state["n"])
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(
            small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        )
