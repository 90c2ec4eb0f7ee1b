"""Near-duplicate vectors of equal label by Euclidean p-stable hashing.

Vectors are normalised; a table's key is its label and ``PER_TABLE`` quantised random
projections floor((p . x + b) / WIDTH), so two vectors at distance c agree in one
projection with a known probability that falls with c. Vectors that share a key in any
of ``TABLES`` tables are compared exactly. Keys of up to ``BLOCK`` vectors travel
together in groups of about ``GROUP`` rows; a key with more is split into blocks of about
``BLOCK`` and each pair of blocks is a group of its own. So no group grows with the
input, and no pair of vectors is written out. Equal vectors are compared once and
counted with their copies.

A pair that shares several keys is counted in the first such table only; a block yields
link counts per vector and, for the components, one link from each vector to the
smallest vector it is linked with there and one along each found component of the block.

At cosine 0.93 (distance 0.374) a table misses a pair with probability 0.66, all 24 of
them with 6e-5; at cosine 0.96 that is 1e-7.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formwork.llm.frames import quoted, stored
from formwork.llm.graph import components, roots

MIN_COSINE = 0.93
TABLES = 24
PER_TABLE = 6
WIDTH = 1.8
BLOCK = 1024
GROUP = 20_000
SEED = 11


def projections(dim: int, tables: int = TABLES, per_table: int = PER_TABLE, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + dim)
    return rng.standard_normal((dim, tables * per_table)), rng.uniform(0, width, tables * per_table)


def bucket_keys(unit: np.ndarray, tables: int = TABLES, per_table: int = PER_TABLE, width: float = WIDTH) -> np.ndarray:
    """64-bit key of every row of normalised vectors in every table."""
    p, b = projections(unit.shape[1], tables, per_table, width)
    cells = np.floor((unit @ p + b) / width).astype(np.int64).reshape(len(unit), tables, per_table)
    key = np.full((len(unit), tables), 0x51_7CC1B7, np.uint64)
    for k in range(per_table):
        key = (key ^ cells[:, :, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.astype(np.int64)


_UNIQUE = ["rep", "copies", "vector", "label"]


def _packed(x: np.ndarray) -> bytes:
    """Bytes of a vector: single precision where that is exact (its length tells)."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return b"4" + single.tobytes() if (single == x).all() else b"8" + x.tobytes()


def _vector(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if raw[:1] == b"4" else np.float64, offset=1).astype(np.float64)


def _dim(raw: bytes) -> int:
    return (len(raw) - 1) // int(raw[:1])


def _normal(v: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector as bytes of doubles or null where it links with nothing)."""
    for batch in batches:
        out = []
        for v in batch.column(2).to_pylist():
            try:
                x = np.array(v, np.float64) if v else None
            except (TypeError, ValueError):
                x = None
            out.append(_packed(x + 0.0) if x is not None and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "label", "vector"])


def _keyed(tables: int, per_table: int, width: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(2).to_pylist()
            for size in sorted({_dim(r) for r in raw}):
                at = [i for i, r in enumerate(raw) if _dim(r) == size]
                for a in range(0, len(at), 2048):
                    some = at[a : a + 2048]
                    keys = bucket_keys(_normal(np.array([_vector(raw[i]) for i in some])), tables, per_table, width)
                    part = batch.take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([size] * len(some), pa.int32()), pa.array([k.tobytes() for k in keys], pa.binary())], names=[*batch.schema.names, "dim", "keys"])

    return run


_FOUND = T.StructType([T.StructField("rep", T.LongType()), T.StructField("links", T.LongType()), T.StructField("near", T.LongType())])


def _compare(least: float):
    """Link the vectors of each (table, key, pair of blocks) of a group."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        order = np.lexsort(tuple(group[c].to_numpy() for c in ("rep", "y", "x", "key", "tab")))
        parts = [group[c].to_numpy()[order] for c in ("tab", "key", "x", "y")]
        rep, copies, blk = (group[c].to_numpy()[order] for c in ("rep", "copies", "blk"))
        change = np.zeros(len(rep), bool)
        change[0] = True
        for p in parts:
            change[1:] |= p[1:] != p[:-1]
        cut = np.append(np.flatnonzero(change), len(rep))
        vectors, keys = group["vector"].to_numpy()[order], group["keys"].to_numpy()[order]
        out = []
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a < 2:
                continue
            unit = _normal(np.array([_vector(v) for v in vectors[a:b]]))
            left, right = (np.flatnonzero(blk[a:b] == p[a]) for p in parts[2:])
            alone = parts[2][a] == parts[3][a]
            i, j = [], []
            for at in range(0, len(left), 256):
                rows = left[at : at + 256]
                one, two = np.nonzero(unit[rows] @ unit[right].T >= least)
                i.append(rows[one])
                j.append(right[two])
            i, j = np.concatenate(i), np.concatenate(j)
            if alone:
                i, j = i[i < j], j[i < j]
            if (table := int(parts[0][a])) and len(i):
                earlier = np.array([np.frombuffer(k, np.int64, table) for k in keys[a:b]])
                fresh = np.concatenate([~(earlier[i[k : k + 65536]] == earlier[j[k : k + 65536]]).any(axis=1) for k in range(0, len(i), 65536)])
                i, j = i[fresh], j[fresh]
            if not len(i):
                continue
            n, own = b - a, copies[a:b].astype(np.float64)
            links = np.bincount(i, own[j], n) + np.bincount(j, own[i], n)
            some = links > 0
            out.append((rep[a:b][some], links[some].astype(np.int64), rep[a:b][roots(n, i, j)][some]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(_FOUND.names, columns)))

    return run


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", min_cosine: float = MIN_COSINE, tables: int = TABLES, per_table: int = PER_TABLE, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """Link vectors of equal, non-null label and cosine of at least ``min_cosine``.

    Returns one row per row of ``vectors``: the id, ``n_links`` (other vectors linked
    directly), ``component_id`` (smallest id reachable by links, its own included) and
    ``kept`` (id = component_id). Vectors that are null, empty, zero or hold null or
    non-finite components, those without label, and those of another length link with
    nothing. Rows repeated under one id count as vectors of their own. No rows give no
    rows; other columns are not read.
    """
    ids = vectors.schema[id_col].dataType
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("string").alias("label"), F.col(quoted(vector_col)).cast("array<double>").alias("vector"))
    clean = stored(rows.mapInArrow(_clean, T.StructType([T.StructField("id", ids), T.StructField("label", T.StringType()), T.StructField("vector", T.BinaryType())])), "vectors")
    usable = clean.where("label is not null and vector is not null and id is not null")
    unique = usable.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    unique = unique.withColumn("rep_id", F.col("rep")).withColumn("rep", F.col("rep").cast("long"))
    schema = T.StructType([*[f for f in unique.select("rep", "copies", "vector", "label").schema.fields], T.StructField("dim", T.IntegerType()), T.StructField("keys", T.BinaryType())])
    keyed = stored(unique.select(*_UNIQUE).mapInArrow(_keyed(tables, per_table, width), schema), "keyed")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("tab")
    entries = keyed.select("*", numbers).withColumn("key", F.xxhash64("label", "dim", "tab", F.substring("keys", F.col("tab") * 8 + 1, 8)))
    large = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    large = stored(large.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "large")
    groups = max(1, keyed.count() * tables // GROUP)
    entries = entries.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    entries = entries.withColumn("blk", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = entries.select("key", "tab", F.least("blk", "o").alias("x"), F.greatest("blk", "o").alias("y"), "blk", "rep", "copies", "vector", "keys", "blocks")
    group = F.when(F.col("blocks") == 1, F.pmod("key", F.lit(groups))).otherwise(F.xxhash64("key", "x", "y"))
    found = stored(pairs.withColumn("g", group).drop("blocks").groupBy("g").applyInPandas(_compare(min_cosine), _FOUND), "found")
    near = components(found.where("rep != near").select("rep", "near"), "rep", "near")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per = unique.select("label", "vector", "rep", "copies").join(links, "rep", "left").join(near, F.col("rep") == F.col("vertex"), "left")
    per = per.select("label", "vector", F.col("copies"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = clean.join(per.withColumnRenamed("label", "l").withColumnRenamed("vector", "v"), (F.col("label") == F.col("l")) & (F.col("vector") == F.col("v")) & F.col("id").isNotNull(), "left")
    n_links = F.when(F.col("copies").isNull(), F.lit(0)).otherwise(F.col("copies") - 1 + F.col("links"))
    component = F.coalesce(F.col("component").cast(ids), F.col("id"))
    return out.select(F.col("id").alias(id_col), n_links.cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
