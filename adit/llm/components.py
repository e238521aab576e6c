"""Connected components of a graph that only exists as a table of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from adit.session import materialize


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of one task as (node, smallest node of its component here), without the smallest themselves."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)  # hook the roots of both ends
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a long, b long); the root is the component's smallest node, which is its own.

    Alternates two steps until nothing changes: every node hands its larger neighbours its smallest neighbour, then its
    smaller ones. Both are a minimum with map-side combining and an equality join, so a node with very many links is never
    gathered in one place; each round is written to the shared folder. Rounds grow with the logarithm of the longest path.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        near = edges.union(edges.select("b", "a")) if larger else edges
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = near.join(low, "a")
        if larger:
            return joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a > b").distinct()

    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()
        if now == mark:
            break
        mark = now
        edges = materialize(star(star(edges, True), False), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
