"""Merkle manifest of a table of records, and octopus multiproofs of its leaves.

A record's leaf is the SHA-256 of its fields, each written with its length. Leaves of
one group, in the order of their ids, are the bottom of the group's tree; ``FANOUT``
consecutive nodes make one of the level above. The roots of the groups, in the order
of the groups, are the bottom of the top tree, whose root names the whole table.

Positions come from a range-partitioned sort: rows are numbered within their range, and
the counts of the ranges are summed up, so no window holds a whole group. A partition
of ``FANOUT ** DEEP`` aligned nodes derives ``DEEP`` levels at once; the tree is complete
after a few rounds, each a sixteenth to the power of ``DEEP`` of the one before.

Proofs are made per leaf partition: it computes the least set of node coordinates that
its wanted leaves cannot derive themselves, fetches these nodes once by a join, derives
the interior nodes that its leaves share, and expands the proof of each leaf from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formwork.llm.frames import quoted, stored

FANOUT = 16
DEEP = 3
TOP = -1
#: Nodes of this level and above, and those of the top tree, are fetched by very many
#: partitions; they are laid out in this many copies for the join.
BUSY_LEVEL = 5
COPIES = 32

NODE = "tree long, level int, index long, size long, hash string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def record_hash(fields: Sequence[Column]) -> Column:
    """Leaf of a record: each field as ``-`` where null, else its length in UTF-8 bytes,
    a colon and its text."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _ranged(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` as a table sorted over ranges: ``part`` is a row's range, ``seq`` its number
    there. Both are written with the rows, so a retried reader sees the same numbers."""
    by = [F.col(c).asc_nulls_first() for c in order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return stored(rows.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("seq")), name)


@dataclass
class Manifest:
    """``leaves``: id, grp, leaf, claimed, tree, position, size (leaves of the tree), block
    (the leaf partition);
    ``nodes``: every node above the leaves of the group trees, and the whole top tree
    (``tree`` = TOP); ``trees``: number of groups; ``root``: hash of the table, None
    for a table without rows."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def _derive(deep: int):
    """The levels above the aligned nodes of one partition."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("index")
        tree, level, size = int(pdf["tree"].iloc[0]), int(pdf["level"].iloc[0]), int(pdf["size"].iloc[0])
        first, hashes, out = int(pdf["index"].iloc[0]), pdf["hash"].tolist(), []
        for _ in range(deep):
            if size == 1:
                break
            hashes = [digest("".join(hashes[a : a + FANOUT])) for a in range(0, len(hashes), FANOUT)]
            first, size, level = first // FANOUT, -(-size // FANOUT), level + 1
            out += [(tree, level, first + i, size, h) for i, h in enumerate(hashes)]
        return pd.DataFrame(out, columns=["tree", "level", "index", "size", "hash"])

    return run


def _grow(bottom: DataFrame, name: str, deep: int) -> DataFrame:
    """All nodes above ``bottom`` (columns of NODE)."""
    spark = bottom.sparkSession
    size = bottom.agg(F.max("size")).first()[0] or 0
    level, made, now = 0, [], bottom
    while size > 1:
        block = F.floor(F.col("index") / (FANOUT**deep)).alias("block")
        up = stored(now.groupBy("tree", block).applyInPandas(_derive(deep), NODE), name)
        made.append(up)
        for _ in range(deep):
            size, level = -(-size // FANOUT), level + 1
        now = up.where((F.col("level") == level) & (F.col("size") > 1))
    out = spark.createDataFrame([], NODE)
    for up in made:
        out = out.unionByName(up)
    return out


def build_manifest(records: DataFrame, id_col: str, group_col: str, leaf_col: str, claimed_col: str | None = None, deep: int = DEEP) -> Manifest:
    """The trees over ``records``, a table of ids, groups and leaf hashes.

    Leaves of a group ascend by id, then by leaf (null ids first); groups ascend by
    their UTF-8 bytes, null first. Rows repeated or without id are leaves of their own.
    ``claimed_col`` names another hash per row that proofs are to be checked with
    (default: the leaf). No rows give no trees and no root.
    """
    rows = records.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(group_col)).cast("string").alias("grp"), F.col(quoted(leaf_col)).alias("leaf"), F.col(quoted(claimed_col or leaf_col)).alias("claimed"))
    ranged = _ranged(rows, ["grp", "id", "leaf"], "leaves")
    runs = stored(ranged.groupBy("part", "grp").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first")), "runs")
    groups = _ranged(runs.groupBy("grp").agg(F.sum("n").alias("size")), ["grp"], "groups")
    shares = groups.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per range
    shares = shares.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    trees = stored(groups.join(shares, "part").select("grp", "size", (F.col("before") + F.col("seq")).alias("tree")), "trees")
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part")) - F.col("n")
    starts = runs.withColumn("start", before - F.col("first")).alias("r").join(trees.alias("t"), F.col("r.grp").eqNullSafe(F.col("t.grp")))
    starts = starts.select(F.col("r.part"), F.col("r.grp"), "start", "tree", "size").alias("s")
    placed = ranged.alias("l").join(starts, (F.col("l.part") == F.col("s.part")) & F.col("l.grp").eqNullSafe(F.col("s.grp")))
    position = F.col("start") + F.col("seq")
    leaves = stored(placed.select("id", F.col("l.grp").alias("grp"), "leaf", "claimed", "tree", position.alias("position"), "size", F.floor(position / (FANOUT**deep)).alias("block")), "placed")
    bottom = leaves.select("tree", F.lit(0).alias("level"), F.col("position").alias("index"), "size", F.col("leaf").alias("hash"))
    lower = _grow(bottom, "nodes", deep)
    count = trees.count()
    tops = bottom.unionByName(lower).where("size = 1")
    tops = stored(tops.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("index"), F.lit(count).cast("long").alias("size"), "hash"), "subroots")
    upper = tops.unionByName(_grow(tops, "top", deep))
    root = upper.where("size = 1").first() if count else None
    return Manifest(leaves, lower.unionByName(upper), count, root and root["hash"])


def missing(known: set[int], size: int, tree: int) -> list[tuple[int, int, int]]:
    """Coordinates (tree, level, index) that the known leaves of a tree need from others
    to derive its root: children of their ancestors that are not ancestors themselves."""
    out, level = [], 0
    while size > 1:
        parents = {i // FANOUT for i in known}
        wanted = {c for p in parents for c in range(p * FANOUT, min(size, (p + 1) * FANOUT))}
        out += [(tree, level, i) for i in sorted(wanted - known)]
        known, size, level = parents, -(-size // FANOUT), level + 1
    return out


def _requests(trees: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, block, size = (int(pdf[c].iloc[0]) for c in ("tree", "block", "size"))
        rows = missing(set(pdf["position"].tolist()), size, tree) + missing({tree}, trees, TOP)
        return pd.DataFrame([(tree, block, *r) for r in rows], columns=["of", "block", "tree", "level", "index"])

    return run


class _Tree:
    """The part of a tree that known and fetched nodes span: runs of siblings by level."""

    def __init__(self, tree: int, size: int, known: dict[int, str], fetched: dict[tuple[int, int, int], str]) -> None:
        self.runs: list[dict[int, list[str]]] = []
        level = 0
        while size > 1:
            runs, parents = {}, {}
            for p in {i // FANOUT for i in known}:
                runs[p] = [known[i] if i in known else fetched[tree, level, i] for i in range(p * FANOUT, min(size, (p + 1) * FANOUT))]
                parents[p] = digest("".join(runs[p]))
            self.runs.append(runs)
            known, size, level = parents, -(-size // FANOUT), level + 1
        self.root = next(iter(known.values()))

    def path(self, i: int) -> list[tuple[str, str]]:
        """Hashes before and after the node at ``i`` and its ancestors, level by level."""
        out = []
        for runs in self.runs:
            run, k = runs[i // FANOUT], i % FANOUT
            out.append(("".join(run[:k]), "".join(run[k + 1 :])))
            i //= FANOUT
        return out


def _expand(trees: int, root: str, siblings: bool, names: list[str]):
    def run(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        tree, size = int(leaves["tree"].iloc[0]), int(leaves["size"].iloc[0])
        fetched = {(t, lv, i): h for t, lv, i, h in zip(nodes["tree"].tolist(), nodes["level"].tolist(), nodes["index"].tolist(), nodes["hash"].tolist())}
        own = _Tree(tree, size, dict(zip(leaves["position"].tolist(), leaves["leaf"].tolist())), fetched)
        top = _Tree(TOP, trees, {tree: own.root}, fetched)
        if top.root != root:
            raise ValueError(f"the nodes of tree {tree} do not give the root of the manifest")
        above = top.path(tree)
        tail = "".join(a + b for a, b in above)
        out = []
        for position, claimed in zip(leaves["position"].tolist(), leaves["claimed"].tolist()):
            below = own.path(position)
            proof = "".join(a + b for a, b in below) + tail
            for a, b in below + above:
                claimed = digest(a + claimed + b)
            out.append((own.root, root, digest(proof), claimed, claimed == root, [proof[k : k + 64] for k in range(0, len(proof), 64)] if siblings else None))
        new = pd.DataFrame(out, columns=["subroot", "root", "proof_sha256", "folded_root", "verified", "siblings"], index=leaves.index)
        return pd.concat([leaves, new], axis=1)[names]

    return run


def prove(manifest: Manifest, wanted: DataFrame | None = None, siblings: bool = False) -> DataFrame:
    """Proofs of leaves of the manifest, all or the ``wanted`` rows of its leaves.

    Returns id, grp, tree, position, leaf, subroot, root, proof_sha256, folded_root (the
    claimed hash folded with the siblings) and verified; ``siblings`` adds the proof
    itself, from the leaf's level to the root, left to right. Every position is wanted
    once at most. Nodes that contradict the root raise.
    """
    leaves = manifest.leaves if wanted is None else wanted
    spark = leaves.sparkSession
    key = leaves.schema["id"].dataType.simpleString()
    schema = f"id {key}, grp string, tree long, position long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    schema += ", siblings array<string>" if siblings else ""
    if manifest.root is None:
        return spark.createDataFrame([], schema)
    asked = leaves.select("tree", "block", "size", "position").groupBy("tree", "block").applyInPandas(_requests(manifest.trees), "of long, block long, tree long, level int, index long")
    bottom = manifest.leaves.select("tree", F.lit(0).alias("level"), F.col("position").alias("index"), F.col("leaf").alias("hash"))
    nodes = manifest.nodes.select("tree", "level", "index", "hash")
    nodes = nodes if wanted is None else nodes.unionByName(bottom)  # leaves are missing only where not all are wanted
    busy = (F.col("level") >= BUSY_LEVEL) | (F.col("tree") == TOP)
    nodes = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(busy, COPIES - 1).otherwise(0))))
    asked = asked.withColumn("copy", F.when(busy, F.pmod(F.xxhash64("of", "block"), F.lit(COPIES)).cast("int")).otherwise(0))
    found = asked.join(nodes, ["tree", "level", "index", "copy"]).select("of", "block", "tree", "level", "index", "hash")
    names = [f.split(" ")[0] for f in schema.split(", ")]
    return leaves.groupBy("tree", "block").cogroup(found.groupBy("of", "block")).applyInPandas(_expand(manifest.trees, manifest.root, siblings, names), schema)


def manifest_proofs(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], claimed: Mapping[str, Column] | None = None, siblings: bool = False, deep: int = DEEP) -> DataFrame:
    """The manifest of ``docs`` and a proof of every row.

    A leaf covers the ``fields`` in their order; ``claimed`` gives, per field, the value
    that is found now in place of the one the manifest was made of, and ``folded_root``
    and ``verified`` judge it. One row per row of ``docs`` (see ``prove``); rows repeated
    or without id are leaves of their own, nulls in fields are told from empty texts,
    texts are hashed whole where they are read, other columns are not read, no rows give
    no rows.
    """
    own = [F.col(quoted(f)) for f in fields]
    now = [(claimed or {}).get(f, c) for f, c in zip(fields, own)]
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(group_col)).alias("grp"), record_hash(own).alias("leaf"), *([record_hash(now).alias("claimed")] if claimed else []))
    rows = stored(rows, "digests")  # texts are read once; the sort that follows reads its input twice
    return prove(build_manifest(rows, "id", "grp", "leaf", "claimed" if claimed else None, deep), siblings=siblings)
