"""Approximate nearest neighbours by largest inner product over robust-pruned graphs.

Distinct vectors are dealt to shards by hash, and each shard is indexed as a directed
graph in one task. Points join in batches: a greedy beam search from the entry point
proposes neighbours, and relaxed distance pruning keeps a diverse set of edges (an edge
is dropped where a kept neighbour is ALPHA times nearer to its end than the point is).
Edges lead back as well; a list that runs over is pruned again. A point that cannot be
reached from the entry gets an edge from its nearest reachable point, so a beam never
ends short of the points there are.

Largest inner product becomes least distance by one more coordinate: points are scaled
to the longest of the shard and lifted onto a common sphere, queries are not lifted.

Every query goes through every shard. Queries travel in blocks, a shard's graph once to
each block, so a task holds one shard and one block, whatever the size of the table. The
members of a beam are scored exactly in double precision before shards are merged.

Equal vectors are one point with the smallest ids that can appear in any result; equal
query vectors are searched once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formwork.llm.frames import quoted, stored

SHARD = 8192
QUERY_BLOCK = 8192
DEGREE = 32
SLACK = 16
ALPHA = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 96
EXPANDED = 4
BATCH = 256
SEED = 17
NEIGHBOURS = 20


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Points scaled to a longest length of 1 and lifted onto the unit sphere."""
    x = vectors / np.abs(vectors).max()
    x = x / np.sqrt((x * x).sum(axis=1).max())
    extra = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))
    return np.hstack([x, extra]).astype(np.float32)


def lowered(queries: np.ndarray) -> np.ndarray:
    """Queries of unit length in the space of lifted points."""
    q = queries / np.abs(queries).max(axis=1, keepdims=True)
    q = q / np.sqrt((q * q).sum(axis=1, keepdims=True))
    return np.hstack([q, np.zeros((len(q), 1))]).astype(np.float32)


class Graph:
    """Directed graph over points; ``edges`` holds a list per point, filled up by -1."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int) -> None:
        self.points, self.edges, self.entry = points, edges, entry
        self.square = (points * points).sum(axis=1)

    @classmethod
    def build(cls, points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, slack: int = SLACK) -> Graph:
        n = len(points)
        centre = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
        graph = cls(points, np.full((n, degree + slack), -1, np.int32), centre)
        order = np.random.default_rng(SEED).permutation(n)
        order = np.concatenate([[centre], order[order != centre]])
        done = min(n, degree + 1)
        first = order[:done]
        for i in first:  # the first points all know each other
            graph.edges[i, : done - 1] = first[first != i]
        while done < n:
            batch = order[done : done + min(BATCH, done)]
            found, near, _ = graph.search(points[batch], beam, EXPANDED)
            graph.edges[batch, :degree] = graph._pruned(batch, found, near, degree, alpha)
            graph._back(batch, degree, alpha)
            done += len(batch)
        graph._reach()
        return graph

    def search(self, queries: np.ndarray, beam: int, expanded: int = EXPANDED) -> tuple[np.ndarray, np.ndarray, int]:
        """Beam search of each query: the ``beam`` nearest points met (ids, squared
        distances less the query's own square; -1 and infinity where there are fewer), in
        order, and the number of distances computed."""
        b, n = len(queries), len(self.points)
        ids = np.full((b, beam), -1, np.int32)
        near = np.full((b, beam), np.inf, np.float32)
        fresh = np.zeros((b, beam), bool)
        ids[:, 0], fresh[:, 0] = self.entry, True
        near[:, 0] = self.square[self.entry] - 2 * (queries @ self.points[self.entry])
        seen = np.zeros((b, n), bool)
        seen[:, self.entry] = True
        last = np.empty((b, n), np.int32)
        width, steps = self.edges.shape[1], 0
        live = np.arange(b)
        while len(live):
            some = np.argsort(~fresh[live], axis=1, kind="stable")[:, :expanded]  # nearest points not yet expanded
            usable = np.take_along_axis(fresh[live], some, 1)
            fresh[live[:, None], some] = False
            new = self.edges[np.where(usable, ids[live[:, None], some], 0)]
            new[~usable] = -1
            new = new.reshape(len(live), -1)
            row, col = np.nonzero(new >= 0)
            point, query = new[row, col], live[row]
            unseen = ~seen[query, point]
            row, col, point, query = row[unseen], col[unseen], point[unseen], query[unseen]
            last[query, point] = np.arange(len(point))  # one of several edges to a point counts
            once = last[query, point] == np.arange(len(point))
            row, col, point, query = row[once], col[once], point[once], query[once]
            seen[query, point] = True
            steps += len(point)
            reach = np.full((len(live), expanded * width), np.inf, np.float32)
            reach[row, col] = self.square[point] - 2 * np.einsum("ij,ij->i", self.points[point], queries[query])
            both = np.concatenate([near[live], reach], axis=1)
            keep = np.argpartition(both, beam - 1, axis=1)[:, :beam]
            part = np.take_along_axis(both, keep, 1)
            keep = np.take_along_axis(keep, np.argsort(part, axis=1, kind="stable"), 1)
            near[live] = np.take_along_axis(both, keep, 1)
            ids[live] = np.where(np.isinf(near[live]), -1, np.take_along_axis(np.concatenate([ids[live], new], axis=1), keep, 1))
            fresh[live] = np.take_along_axis(np.concatenate([fresh[live], np.ones_like(new, bool)], axis=1), keep, 1) & ~np.isinf(near[live])
            live = live[fresh[live].any(axis=1)]
        return ids, near, steps

    def _pruned(self, of: np.ndarray, found: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
        """Diverse neighbours of points ``of`` among candidates in order of distance."""
        near = np.maximum(0, near + self.square[of][:, None])
        alive = (found >= 0) & (found != of[:, None])
        c = self.points[np.maximum(found, 0)]
        square = self.square[np.maximum(found, 0)]
        apart = square[:, :, None] + square[:, None, :] - 2 * (c @ c.transpose(0, 2, 1))
        apart *= alpha * alpha
        kept = np.full((len(of), degree), -1, np.int32)
        count = np.zeros(len(of), np.int64)
        for j in range(found.shape[1]):
            row = np.flatnonzero(alive[:, j] & (count < degree))
            kept[row, count[row]] = found[row, j]
            count[row] += 1
            alive[row] &= apart[row, j] > near[row]
        return kept

    def _back(self, batch: np.ndarray, degree: int, alpha: float) -> None:
        """Lead the edges of the batch back; prune the lists that run over."""
        row, col = np.nonzero(self.edges[batch] >= 0)
        end, start = self.edges[batch][row, col], batch[row]
        known = (self.edges[end] == start[:, None]).any(axis=1)
        end, start = end[~known], start[~known]
        order = np.argsort(end, kind="stable")
        end, start = end[order], start[order]
        points, first, new = np.unique(end, return_index=True, return_counts=True)
        held = (self.edges[points] >= 0).sum(axis=1)
        at = np.arange(len(end)) - np.repeat(first, new) + np.repeat(held, new)
        fits = held + new <= self.edges.shape[1]
        easy = np.repeat(fits, new)
        self.edges[end[easy], at[easy]] = start[easy]
        over, each = points[~fits], (held + new)[~fits]
        for size in np.unique(-(-each // 32)):  # lists of like length together
            some = np.flatnonzero(-(-each // 32) == size)
            for a in range(0, len(some), max(1, 2_000_000 // int(size * 32) ** 2)):
                at_once = over[some[a : a + max(1, 2_000_000 // int(size * 32) ** 2)]]
                lists = np.full((len(at_once), int(size) * 32), -1, np.int32)
                for i, p in enumerate(at_once):
                    own = self.edges[p][self.edges[p] >= 0]
                    lo = np.searchsorted(end, p)
                    more = start[lo : lo + new[np.searchsorted(points, p)]]
                    lists[i, : len(own) + len(more)] = np.concatenate([own, more])
                x = self.points[np.maximum(lists, 0)]
                near = self.square[np.maximum(lists, 0)] - 2 * (x @ self.points[at_once][:, :, None])[:, :, 0]
                near[lists < 0] = np.inf
                order = np.argsort(near, axis=1, kind="stable")
                self.edges[at_once] = -1
                self.edges[at_once, :degree] = self._pruned(at_once, np.take_along_axis(lists, order, 1), np.take_along_axis(near, order, 1), degree, alpha)

    def reachable(self) -> np.ndarray:
        seen = np.zeros(len(self.points), bool)
        front = np.array([self.entry])
        while len(front):
            seen[front] = True
            ends = np.unique(self.edges[front])
            ends = ends[ends >= 0]
            front = ends[~seen[ends]]
        return seen

    def _reach(self) -> None:
        lost = np.flatnonzero(~self.reachable())
        for a in range(0, len(lost), BATCH):
            some = lost[a : a + BATCH]
            for p, q in zip(some, self.search(self.points[some], BUILD_BEAM)[0][:, 0]):
                free = np.flatnonzero(self.edges[q] < 0)
                if not len(free):
                    self.edges = np.hstack([self.edges, np.full((len(self.points), 8), -1, np.int32)])
                    free = np.flatnonzero(self.edges[q] < 0)
                self.edges[q, free[0]] = p


def usable(vector: Column) -> Column:
    """Whether a vector is there, not zero, and holds finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vector = F.transform(F.col(quoted(vector_col)).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("id"), vector.alias("vector"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("vector"))).distinct()


@dataclass
class Index:
    """``nodes``: size (of the vectors), shard, node, members (smallest ids of the vector),
    vector, edges, entry; at most ``shards`` shards for each size."""

    nodes: DataFrame
    shards: int
    neighbours: int


_NODES = "size int, shard long, node int, members array<long>, vector array<double>, edges array<int>, entry boolean"


def _indexed(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.assign(least=[m[0] for m in pdf["members"]])
    pdf["bytes"] = [v.tobytes() for v in pdf["vector"]]
    pdf = pdf.sort_values(["least", "bytes"]).reset_index(drop=True)  # the same graph in every attempt
    graph = Graph.build(lifted(np.stack(pdf["vector"].to_numpy())))
    pdf["node"] = np.arange(len(pdf), dtype=np.int32)
    pdf["edges"] = [e[e >= 0] for e in graph.edges]
    pdf["entry"] = pdf["node"] == graph.entry
    return pdf[["size", "shard", "node", "members", "vector", "edges", "entry"]]


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", neighbours: int = NEIGHBOURS, shard: int = SHARD) -> Index:
    """Index all vectors for results of up to ``neighbours`` (one more id is kept per
    distinct vector, for the query's own). Vectors that are null, empty, zero or hold
    null or non-finite components, and rows without id, are left out; rows repeated
    whole count once; no rows give no nodes."""
    rows = stored(_rows(vectors, id_col, vector_col), "vectors")
    least = rows.withColumn("r", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("r") <= neighbours + 1)
    points = stored(least.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("members")), "points")
    shards = max(1, -(-points.count() // shard))
    dealt = points.select(F.size("vector").alias("size"), F.pmod(F.xxhash64("vector"), F.lit(shards)).alias("shard"), "members", "vector")
    return Index(stored(dealt.groupBy("size", "shard").applyInPandas(_indexed, _NODES), "graphs"), shards, neighbours)


def _beams(neighbours: int, beam: int):
    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(nodes) and len(queries):
            nodes = nodes.sort_values("node")
            vectors = np.stack(nodes["vector"].to_numpy())
            members = nodes["members"].to_numpy()
            least = np.array([m[0] for m in members])
            degree = nodes["edges"].map(len).to_numpy()
            edges = np.full((len(nodes), max(1, degree.max())), -1, np.int32)
            edges[np.repeat(np.arange(len(nodes)), degree), np.concatenate([np.arange(d) for d in degree])] = np.concatenate(nodes["edges"].to_numpy())
            graph = Graph(lifted(vectors), edges, int(np.flatnonzero(nodes["entry"].to_numpy())[0]))
            asked, keys = np.stack(queries["vector"].to_numpy()), queries["key"].tolist()
            for a in range(0, len(asked), BATCH):
                found, _, _ = graph.search(lowered(asked[a : a + BATCH]), beam)
                with np.errstate(over="ignore", invalid="ignore"):
                    score = np.einsum("bkd,bd->bk", vectors[np.maximum(found, 0)], asked[a : a + BATCH])
                order = np.where(found >= 0, np.nan_to_num(score, nan=-np.inf), -np.inf)
                for i, key in enumerate(keys[a : a + BATCH]):
                    best = np.lexsort((least[found[i]], -order[i], found[i] < 0))[: neighbours + 1]
                    for j in best[found[i, best] >= 0]:
                        out += [(key, int(m), float(score[i, j])) for m in members[found[i, j]]]
        return pd.DataFrame(out, columns=["key", "id", "score"])

    return run


def search_index(index: Index, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = SEARCH_BEAM, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The nearest indexed vectors of every query, by inner product.

    Returns query_id, rank (from 1), vec_id, score (the inner product in double
    precision), nearest first, ties to the smaller vec_id; all vectors of the query's
    length where there are fewer than the index was made for. Rows of the query's own id
    are none of its results. Queries that are no usable vector or lack an id give no
    rows; one repeated whole is asked once; no queries or no nodes give no rows.
    """
    k = index.neighbours
    asked = stored(_rows(queries, id_col, vector_col).withColumn("key", F.md5(F.to_json(F.struct("vector")))), "queries")
    distinct = asked.groupBy("key").agg(F.first("vector").alias("vector"))
    blocks = max(1, -(-distinct.count() // query_block))
    sent = distinct.select(F.size("vector").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(index.shards - 1).cast("long"))).alias("shard"), F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), "key", "vector")
    graphs = index.nodes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    by = ["size", "shard", "block"]
    found = graphs.groupBy(*by).cogroup(sent.groupBy(*by)).applyInPandas(_beams(k, beam), "key string, id long, score double")
    nearest = [F.when(F.isnan("score"), F.lit(float("-inf"))).otherwise(F.col("score")).desc(), F.col("id")]
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy(*nearest))).where(F.col("r") <= k + 1).drop("r")
    best = stored(best, "nearest").select("key", F.col("id").alias("vec_id"), "score")
    pairs = asked.select("id", "key").join(best, "key").where("id != vec_id")
    rank = F.row_number().over(Window.partitionBy("id", "key").orderBy(nearest[0], "vec_id"))
    return pairs.select(F.col("id").alias("query_id"), rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
