"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.common import forget, stash


def components(edges: DataFrame) -> DataFrame:
    """(node, component_id) for every node of *edges* (a, b), the smallest node of its component.

    Edges with a null end and self-links are ignored.  Minima are aggregated before they are
    shuffled and joined back, so a node with very many links is no single task's work: the join
    is one that adaptive execution can split.  Each round is written to the shared folder.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    now = stash(edges.filter("a is not null and b is not null and a <> b").select(a.alias("a"), b.alias("b")).distinct())
    seen = None
    while True:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        # named anew, minima are dealt out again for the join, which then can split the links of a hub
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).select(F.col("u").bitwiseXOR(F.lit(0)).alias("u"), "m")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").bitwiseXOR(F.lit(0)).alias("a"), "m")
        paired = large.join(lowest, "a")
        small = paired.select("a", F.col("m").alias("b")).unionByName(paired.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        before, now = now, stash(small.distinct())
        forget(before)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.count_distinct("a")).first()
        if state == seen and state[0] == state[2]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct())
        seen = state


class MinForest:
    """Union-find over 0..n-1 in numpy; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            over = self.parent[up]
            if np.array_equal(over, up):
                return up
            self.parent[x] = over
            up = self.parent[over]

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            rx, ry = self.find(x), self.find(y)
            apart = rx != ry
            x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
            np.minimum.at(self.parent, np.maximum(rx, ry), np.minimum(rx, ry))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(members that aren't roots, their roots)."""
        roots = self.find(np.arange(len(self.parent)))
        inner = np.flatnonzero(roots != np.arange(len(roots)))
        return inner, roots[inner]
