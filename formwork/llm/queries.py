"""The registered queries of the operators in this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formwork.llm import oracles
from formwork.llm.alignment import RESULTS, align_tokenizers
from formwork.llm.bpe_automaton import encode_decode
from formwork.llm.embedding_dedup import link_vectors
from formwork.llm.frames import ship, stored
from formwork.llm.graph_search import build_index, search_index
from formwork.llm.licenses import scan_licenses
from formwork.llm.merkle import manifest_proofs
from formwork.llm.minhash_dedup import near_duplicates
from formwork.llm.packing import best_fit_pack, token_pieces
from formwork.llm.personal_data import find_personal_data, n_base, span_digest
from formwork.llm.quality import judge_quality
from formwork.llm.revisits import resolve_revisits
from formwork.llm.secrets import find_secrets
from formwork.llm.substring_dedup import remove_repeated_passages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op6_quality_rules": oracles.QUALITY,
    "op8_embedding_dedup": oracles.EMBEDDING_DEDUP,
    "op13_merkle_manifest": oracles.MERKLE,
}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and the digest of the kept words of every document."""
    out = remove_repeated_passages(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    out = encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every token piece of every document."""
    pieces = token_pieces(table(spark, sf_dir, "documents", "doc_id", "text"))
    pieces = stored(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return best_fit_pack(pieces, ["doc_id", "piece"])


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the pattern spans, all spans."""
    out = find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "spans")
    counts = [n_base(F.col("spans"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    base = span_digest(F.filter("spans", lambda s: s["base"]))
    return out.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), span_digest(F.col("spans")).alias("spans"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the pattern spans, all spans."""
    out = find_secrets(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "spans")
    counts = [n_base(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")]
    base = span_digest(F.filter("spans", lambda s: s["base"]))
    return out.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), span_digest(F.col("spans")).alias("spans"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    out = judge_quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    out = link_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))
    return out.select("vec_id", "n_links", F.col("component_id").cast("long").alias("component_id"), "kept")


@query
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document, as licence:start:end, and their differences."""
    out = scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))
    notices = F.col("notices")
    return out.select(
        "doc_id",
        F.size(notices).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(notices["license"])), ",").alias("licenses"),
        F.array_join(F.transform(notices, lambda n: F.concat_ws(":", n["license"], n["start"], n["end"])), ",").alias("spans"),
        F.aggregate(notices, F.lit(0), lambda a, n: a + F.size(n["missing"]) + F.size(n["added"])).cast("long").alias("n_word_differences"),
    )


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers cut every document, and how usual its links are."""
    return align_tokenizers(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", *RESULTS)


@query
def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return search_index(build_index(vectors), vectors.where("vec_id % 20 = 0"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether the proof holds for the text
    found now: that of every document whose id's checksum 5 divides is in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    now = F.when(tampered, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    out = manifest_proofs(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"], {"text": now})
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: Captures that a crawler would have made of the pages: every page once in full, and a
#: later (some: earlier) conditional request under another spelling of its URL, answered
#: with 304 and entity tag, date, both stale, or none. One SQL text for both engines.
CAPTURES = """
SELECT 2 * page_id AS record_id, url, 10 * page_id AS time, 'response' AS type,
       concat('"', md5(html), '"') AS etag,
       concat('day ', CAST(floor(page_id / 3) AS BIGINT)) AS last_modified,
       'text/html' AS content_type, 'max-age=60' AS cache_control, md5(html) AS digest
FROM pages
UNION ALL
SELECT 2 * page_id + 1 AS record_id,
       CASE page_id % 4 WHEN 0 THEN url
            WHEN 1 THEN concat(url, '#part')
            WHEN 2 THEN replace(replace(url, 'https://', 'HTTP://WWW.'), 'http://www.', 'http://www2.')
            ELSE concat(url, CASE WHEN url LIKE '%?%' THEN '&' ELSE '?' END, 'utm_medium=x') END AS url,
       CASE WHEN page_id % 11 = 0 THEN 10 * page_id - 5 ELSE 10 * page_id + 5 END AS time, 'revisit' AS type,
       CASE WHEN page_id % 7 = 0 THEN '"stale"' WHEN page_id % 5 IN (0, 1) THEN NULL ELSE concat('W/"', md5(html), '"') END AS etag,
       CASE WHEN page_id % 5 = 0 THEN concat('day ', CAST(floor(page_id / 3) AS BIGINT)) END AS last_modified,
       'text/plain' AS content_type, concat('max-age=', page_id % 9) AS cache_control,
       CASE WHEN page_id % 10 = 1 THEN md5(html) END AS digest
FROM pages
"""


@query
def op5_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response, status and merged headers of every not-modified capture."""
    captures = spark.sql(CAPTURES.replace("FROM pages", "FROM {pages}"), pages=table(spark, sf_dir, "pages", "page_id", "url", "html"))
    names = {"etag": "ETag", "last_modified": "Last-Modified", "content_type": "Content-Type", "cache_control": "Cache-Control"}
    headers = F.map_filter(F.create_map(*[x for c, n in names.items() for x in (F.lit(n), F.col(c))]), lambda k, v: v.isNotNull())
    out = resolve_revisits(captures.withColumn("headers", headers))
    joined = F.array_join(F.transform("headers", lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return out.select("record_id", "url_key", "target_id", "status", joined.alias("headers"))


ORACLE["op5_revisit_resolution"] = (
    "WITH captures AS (" + CAPTURES + r"""), bare AS (
  SELECT *, regexp_replace(trim(url), '#[\s\S]*$', '') AS b FROM captures),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^([^@]*@)?(www[0-9]*\.)?', ''), ':(80|443)$', '') AS host,
         regexp_replace(b, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM bare),
keyed AS (
  SELECT *, list_sort(list_filter(string_split(regexp_extract(rest, '\?([\s\S]*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid)(=|$)'))) AS q FROM parts),
c AS (
  SELECT *, concat(host, regexp_replace(regexp_extract(rest, '^([^?]*)', 1), '/+$', ''), CASE WHEN len(q) > 0 THEN concat('?', array_to_string(q, '&')) ELSE '' END) AS k FROM keyed),
r AS (SELECT * FROM c WHERE type = 'revisit'),
t AS (
  SELECT r.record_id, max(s.record_id) AS target_id
  FROM r JOIN c s ON s.type = 'response' AND s.k = r.k AND s.time < r.time
  WHERE s.time = (SELECT max(x.time) FROM c x WHERE x.type = 'response' AND x.k = r.k AND x.time < r.time)
  GROUP BY r.record_id),
j AS (
  SELECT r.*, t.target_id, s.etag AS s_etag, s.last_modified AS s_date, s.digest AS s_digest, s.content_type AS s_type,
         CASE WHEN trim(r.k) = '' OR r.k IS NULL THEN 'no_url' WHEN t.target_id IS NULL THEN 'no_response'
              WHEN r.etag IS NOT NULL THEN CASE WHEN regexp_replace(r.etag, '^W/', '') = s.etag THEN 'resolved' ELSE 'mismatch' END
              WHEN r.last_modified IS NOT NULL THEN CASE WHEN r.last_modified = s.last_modified THEN 'resolved' ELSE 'mismatch' END
              WHEN r.digest IS NOT NULL THEN CASE WHEN r.digest = s.digest THEN 'resolved' ELSE 'mismatch' END
              ELSE 'unchecked' END AS status
  FROM r LEFT JOIN t ON t.record_id = r.record_id LEFT JOIN c s ON s.record_id = t.target_id AND s.type = 'response')
SELECT record_id, k AS url_key, target_id, status,
       concat_ws(';', 'cache-control=' || cache_control,
                 'content-type=' || CASE WHEN status IN ('resolved', 'unchecked') THEN s_type ELSE content_type END,
                 'etag=' || CASE WHEN status IN ('resolved', 'unchecked') THEN coalesce(etag, s_etag) ELSE etag END,
                 'last-modified=' || CASE WHEN status IN ('resolved', 'unchecked') THEN coalesce(last_modified, s_date) ELSE last_modified END) AS headers
FROM j"""
)
