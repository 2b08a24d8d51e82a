"""Connected components by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import ready, written

FEW = 200_000  # edges that one task joins at once


def _toward_minimum(edges: DataFrame, small: bool) -> DataFrame:
    """One round: neighbours of a node are tied to the smallest node next to it instead."""
    if small:  # each node with its smaller neighbours
        seen = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    else:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = seen.join(least, "u")
    if small:
        out = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).union(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    else:
        out = moved.filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return out.filter("a < b").distinct()


def _joined(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Smallest node of each component of a few edges."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pd.DataFrame({"node": np.array(nodes, np.int64), "component": np.array([root(x) for x in nodes], np.int64)})


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """Rows (node, component): the smallest node of each node's component, from edges (a, b).

    Only nodes of an edge between two nodes are there. Rounds of stars go on until a round
    changes nothing, about as many as the logarithm of the longest chain; ``few`` edges or
    less need no rounds, as one task can hold them.
    """
    ready(edges.sparkSession)
    edges = edges.filter("a is not null and b is not null and a <> b").select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b")).distinct()
    edges, state = written(edges, "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.xxhash64("b", "a") % 998_244_353)).first()
        if now[0] <= few:
            return written(edges.repartition(1).mapInPandas(_joined, "node long, component long"), "joined")
        if now == state:
            break
        state = now
        edges = written(_toward_minimum(_toward_minimum(edges, small=False), small=True), "edges")
    ends = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return ends.union(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
