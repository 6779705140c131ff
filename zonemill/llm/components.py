"""Distributed connected components by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonemill.llm.common import written


def merged(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots after the links x–y of one task are added; ``root`` points straight at the least member."""
    while True:
        a, b = root[x], root[y]
        apart = a != b
        if not apart.any():
            return root
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each id.

    Found by id and part, so that a join with it is one of plain exchanges, in which adaptive
    execution can split the links of an id that many others are linked to.
    """
    part = F.pmod(F.xxhash64("a"), F.lit(2)).alias("_part")
    return links.groupBy("a", part).agg(F.min("b").alias("m")).select("a", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.filter(F.col("b") > F.col("a")).join(_least(both), "a")
    return joined.select(F.col("b").alias("a"), F.least("m", "a").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    least = _least(down)
    lifted = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lifted.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Links (a, b) between ids to (id, component): the smallest id reachable, for every linked id.

    Each round halves the paths; every round is written to the shared folder, so that a
    lost executor costs one round at most. Only two sums of a round reach the driver.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter(F.col("a") != F.col("b"))
        .distinct(),
        name,
    )
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    before = None
    while True:
        now = written(_small_star(_large_star(now)), name)
        after = tuple(now.agg(F.count(F.lit(1)), mark).first())
        if after == before:
            break
        before = after
    below = now.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return below.unionByName(roots)
