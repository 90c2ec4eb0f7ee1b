"""Not-modified revisits of web captures, resolved by an as-of join.

A revisit (304) is answered by the latest earlier full response of the same canonical
URL. Its validators are checked against that response, and its headers, where a 304 may
change them, replace those of the response.

The join is a running maximum: captures are cut into ``SLICES`` slices of time of about
equal size, the latest response of each URL and slice is found by an aggregate that is
combined before the shuffle and carried to the later slices of the URL, and within a
slice a window over (URL, slice) in order of time finds the latest one. So a URL with a
large share of all captures is spread over the slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formwork.llm.frames import quoted

SLICES = 64
#: Headers that a 304 must not change (fixed values).
FIXED_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")
#: Query parameters that do not name a resource.
TRACKING = r"^(utm_[a-z]+|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host (lower case, without user, ``www`` and default port), path without trailing
    slash, and sorted query parameters without tracking ones; no scheme, no fragment."""
    bare = F.regexp_replace(F.trim(url), r"#[\s\S]*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^([^@]*@)?(www[0-9]*\.)?", ""), r":(80|443)$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^([^?]*)", 1), r"/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(rest, r"\?([\s\S]*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _opaque(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(etag), r"^W/", "")


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda e: e["key"] == name), F.lit(0))["value"]


def resolve_revisits(captures: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "time", type_col: str = "type", headers_col: str = "headers", digest_col: str = "digest") -> DataFrame:
    """One row per revisit of ``captures``: ``record_id``, ``url_key``, ``target_id`` (the
    latest earlier response of the canonical URL; of several at one time that with the
    greatest id), ``status`` and ``headers`` (array of key and value sorted by key, lower
    case; those of the revisit alone where it is not resolved).

    ``captures`` has an id, a URL, a time (an integer), a type (``response`` or
    ``revisit``; others are ignored), headers (map of text to text) and a payload
    digest. ``status`` is ``no_url`` (null or blank URL), ``no_time``, ``no_response``,
    ``mismatch`` (an entity tag, else a modification date, else a digest of the revisit
    that the response does not have), ``unchecked`` (the revisit has none) or
    ``resolved``. Of a header repeated in different case the last by name counts. Rows
    repeated under one id give repeated rows. No rows give no rows; other columns are
    not read.
    """
    c = {n: F.col(quoted(x)) for n, x in (("id", id_col), ("url", url_col), ("time", time_col), ("type", type_col), ("headers", headers_col), ("digest", digest_col))}
    pairs = F.coalesce(F.map_entries(c["headers"]), F.array().cast("array<struct<key:string,value:string>>"))
    pairs = F.array_sort(F.transform(pairs, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))
    rows = captures.select(c["id"].alias("id"), canonical_url(c["url"].cast("string")).alias("key"), c["time"].cast("long").alias("time"), (c["type"] == "revisit").alias("revisit"), pairs.alias("pairs"), c["digest"].cast("string").alias("digest")).where(c["type"].isin("response", "revisit"))
    usable = (F.trim("key") != "") & F.col("time").isNotNull()
    bounds = rows.where(usable).agg(F.percentile_approx("time", [i / SLICES for i in range(1, SLICES)], 10_000).alias("b")).first()["b"] or []
    # slices are cut at the bounds: a time belongs to the slice after all bounds below it
    cut = F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(bounds))]), lambda b: b <= F.col("time"))) if bounds else F.lit(0)
    full = F.when(~F.col("revisit"), F.struct("time", "id", "pairs", "digest"))
    timed = rows.where(usable).withColumn("slice", cut).withColumn("full", full)
    slices = timed.groupBy("key", "slice").agg(F.max("full").alias("latest"))
    carried = slices.select("key", "slice", F.max("latest").over(Window.partitionBy("key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    within = Window.partitionBy("key", "slice").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    found = timed.withColumn("target", F.max("full").over(within)).where("revisit").join(carried, ["key", "slice"]).withColumn("target", F.coalesce("target", "carried"))
    columns = ["id", "key", "time", "pairs", "digest", "target"]
    none = rows.where("revisit").where(~F.coalesce(usable, F.lit(False))).withColumn("target", F.lit(None).cast(found.schema["target"].dataType))
    out = found.select(*columns).unionByName(none.select(*columns))
    target, own = F.col("target"), F.col("pairs")
    etag, date = _header(own, "etag"), _header(own, "last-modified")
    agrees = (
        F.when(etag.isNotNull(), _opaque(etag).eqNullSafe(_opaque(_header(target["pairs"], "etag"))))
        .when(date.isNotNull(), date.eqNullSafe(_header(target["pairs"], "last-modified")))
        .when(F.col("digest").isNotNull(), F.col("digest").eqNullSafe(target["digest"]))
    )
    status = (
        F.when(F.coalesce(F.trim("key"), F.lit("")) == "", "no_url")
        .when(F.col("time").isNull(), "no_time")
        .when(target.isNull(), "no_response")
        .when(agrees.isNull(), "unchecked")
        .when(agrees, "resolved")
        .otherwise("mismatch")
    )
    out = out.withColumn("status", status)
    allowed = F.filter(own, lambda e: ~e["key"].isin(*FIXED_HEADERS))
    kept = F.filter(target["pairs"], lambda e: ~F.exists(allowed, lambda o: o["key"] == e["key"]))
    merged = F.when(F.col("status").isin("resolved", "unchecked"), F.array_sort(F.concat(kept, allowed))).otherwise(own)
    return out.select(F.col("id").alias("record_id"), F.col("key").alias("url_key"), target["id"].alias("target_id"), "status", merged.alias("headers"))
