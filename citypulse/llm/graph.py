"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: undirected, any order);
    root is the smallest node value of the component. Loops until nothing changes.

    Each round keeps one row per node and neighbour and joins it to the
    smallest neighbour of its node: both sides are hashed by that node, so a
    hub's rows can be split by the adaptive skew join.
    """
    tree = saved(_ordered(edges), "cc")
    seen = None
    while True:
        star = _star(tree, larger_only=True)
        tree = saved(_star(star, larger_only=False), "cc")
        mark = tree.agg(F.count("*").alias("n"),
                        F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        mark = (mark["n"], mark["h"])
        if mark == seen:
            break
        seen = mark
    # at the fixed point every node hangs directly below its root
    return (tree.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
            .union(tree.select("lo", "lo")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
            .where(F.col("hi") != F.col("lo")).distinct())


def _star(tree: DataFrame, larger_only: bool) -> DataFrame:
    """One star step. Large star: each node's larger neighbours are linked to the
    smallest of the node and its neighbours. Small star: a node and its smaller
    neighbours are linked to the smallest of these."""
    if larger_only:
        near = tree.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            tree.select(F.col("lo"), F.col("hi")))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        linked = (near.join(least, "u").where(F.col("v") > F.col("u"))
                  .select(F.col("v").alias("a"), F.least("m", "u").alias("b")))
    else:
        least = tree.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
        near = tree.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        linked = (near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                  .union(least.select(F.col("u"), F.col("m"))))
    return _ordered(linked)


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) over the links a-b of one task, without the roots:
    as many rows as nodes, whatever the number of links."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        for k in (i, j, label[i], label[j]):
            np.minimum.at(new, k, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]
