"""Connected components of a link table, by alternating large and small stars.

Each round keeps the components and moves every vertex closer to the smallest one of
its component: a vertex links its larger neighbours (large star), then all its smaller
neighbours and itself (small star), to its smallest neighbour. Minima are combined
before the shuffle, and links are re-read from files each round, so neither a vertex
with very many links nor a lost executor stalls it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formwork.llm.frames import stored


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = _least(links)
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """``vertex`` and ``component`` (its smallest vertex) for every vertex of a link.

    Links are undirected, in any order; repeated links and links of a vertex to itself
    do nothing; a vertex without a link to another does not appear; null ends are
    dropped. An empty table gives an empty result.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a != b")
    now = stored(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    mark = None
    while True:
        now = stored(_small_star(_large_star(now)), name)
        # stars only: no vertex is both below and above a link, and links no longer change
        total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == mark:
            break
        mark = tuple(total)
    hubs = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(hubs)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 by the links i-j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
