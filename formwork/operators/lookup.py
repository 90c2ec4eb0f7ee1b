"""Left lookup join that neither null keys nor hot keys pile into one partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NULL_KEY_BUCKETS = 1024
#: A key with at least this share of the rows is hot; a sketch of TRACKED counters finds
#: every key above 1 / (0.75 * TRACKED) of the rows, and at most HOT_KEYS can be hot.
HOT_SHARE = 1 / 64
HOT_KEYS = 64
TRACKED = 4096


def fits_broadcast(lookup: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast the frame."""
    size = lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size <= limit


def hot_keys(df: DataFrame, key: Column) -> list:
    """The keys that hold at least HOT_SHARE of the rows with a key, from a
    heavy-hitter sketch: one pass over the key alone, merged map-side."""
    keys = df.select(key.alias("k")).where("k is not null")
    row = keys.agg(F.expr(f"approx_top_k(k, {HOT_KEYS}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in row["top"] or [] if r["count"] >= HOT_SHARE * row["n"]]


def left_lookup(df: DataFrame, key: Column, lookup: DataFrame, lookup_key: str, buckets: int = NULL_KEY_BUCKETS, hot: Sequence | None = None) -> DataFrame:
    """``df`` left-joined to ``lookup`` (one row per ``lookup_key``) on ``key``.

    Rows whose key is null can match nothing, yet a plain join sends all of them to the
    partition of the null key; unanswered questions or id-less rows can be a third of
    the input. Such rows get a bucket from a hash of their content as their join key,
    and the join condition requires a real key, so they spread over ``buckets``
    partitions, still match nothing, and fall in the same bucket when a task is
    retried. The equi-key stays the single lookup key, so a lookup already partitioned
    by it (e.g. the output of a group-by on it) is not shuffled again; small lookups are
    broadcast by Spark's size statistics or AQE and nothing is shuffled at all.

    ``hot`` lists keys of very many rows (``hot_keys``). Their lookup rows, one per key,
    are broadcast, and the rows that hold them are spread like those without a key."""
    hot = list(hot or [])
    names = [c for c in lookup.columns if c != lookup_key]
    real = key.isNotNull() & ~key.isin(hot) if hot else key.isNotNull()
    columns = [F.col("`" + c + "`") for c in df.columns]
    if hot:
        found = [F.col(f"`{c}`").alias(f"__lk_hot_{i}") for i, c in enumerate(names)]
        few = lookup.where(F.col(f"`{lookup_key}`").isin(hot)).select(F.col(f"`{lookup_key}`").alias("__lk_hot"), *found)  # at most len(hot) rows
        df = df.select("*", key.alias("__lk_of")).join(F.broadcast(few), F.col("__lk_of") == F.col("__lk_hot"), "left").drop("__lk_of", "__lk_hot")
    key_type = df.select(key.alias("k")).schema[0].dataType
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast(key_type)
    keyed = df.select("*", F.when(real, key).otherwise(bucket).alias("__lk_key"), real.alias("__lk_real"))
    cond = (F.col("__lk_key") == F.col(f"`{lookup_key}`")) & F.col("__lk_real")
    joined = keyed.join(lookup, cond, "left")
    if not hot:
        return joined.drop("__lk_key", "__lk_real", lookup_key)
    both = [F.coalesce(F.col(f"`{c}`"), F.col(f"__lk_hot_{i}")).alias(c) for i, c in enumerate(names)]
    return joined.select(*columns, *both)
