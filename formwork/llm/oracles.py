"""DuckDB SQL of the operators that SQL can express, over the driver's tables."""

from __future__ import annotations

from formwork.llm.embedding_dedup import MIN_COSINE
from formwork.llm.quality import COMMON_WORDS, LIMITS
from formwork.llm.substring_dedup import WINDOW

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - {WINDOW - 2}), lambda i: md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')))) AS h,
         unnest(range(1, len(w) - {WINDOW - 2})) AS i
  FROM d WHERE len(w) >= {WINDOW}),
r AS (SELECT doc_id, i FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
x AS (SELECT DISTINCT doc_id, i + k AS i FROM r, range(0, {WINDOW}) AS t(k)),
p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM p ANTI JOIN x USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM x GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)
"""

_UNIT = "list_transform({0}, lambda x: x / list_sum({0}))"


def _distance(counts: str, reference: str) -> str:
    p, q = _UNIT.format(counts), reference
    side = "CASE WHEN t[{0}] > 0 THEN 0.5 * t[{0}] * log2(t[{0}] / ((t[1] + t[2]) / 2)) ELSE 0 END"
    return f"sqrt(greatest(0, list_sum(list_transform(list_zip({p}, {q}), lambda t: {side.format(1)} + {side.format(2)}))))"


def _quality() -> str:
    lists = "\n".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in COMMON_WORDS.items())
    n_bins = max(map(len, COMMON_WORDS.values())) + 1
    sums = lambda c, n: ", ".join(f"sum({c}[{i}])" for i in range(1, n + 1))
    m = LIMITS
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w, CASE lang {lists} END AS own, lang FROM documents),
c AS (
  SELECT doc_id, t, w, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS letters, length(regexp_replace(t, '[^0-9]+', '', 'g')) AS digits,
         length(regexp_replace(t, '[\x00-\x7F]+', '', 'g')) AS others,
         list_transform(own, lambda k: len(list_filter(w, lambda x: x = k))) AS bins,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM d),
h AS (
  SELECT *, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         [letters::DOUBLE, others, digits, n_symbols, length(t) - word_chars, word_chars - letters - others - digits - n_symbols] AS cc,
         list_transform(list_append(bins, n_words - list_sum(bins)), lambda x: x::DOUBLE) AS wc
  FROM c),
ref AS (
  SELECT lang, [{sums("cc", 6)}] AS rc, [{sums("wc", n_bins)}] AS rw FROM h WHERE wc IS NOT NULL GROUP BY lang),
u AS (SELECT lang, {_UNIT.format("rc")} AS rc, {_UNIT.format("rw")} AS rw FROM ref),
g AS (
  SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: md5(concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])))) AS h,
         unnest(range(1, len(w) - 3)) AS i
  FROM d WHERE len(w) >= 5),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, h) AS n FROM g) WHERE n > 1),
x AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS i FROM r, range(0, 5) AS t(k)) GROUP BY doc_id),
j AS (
  SELECT h.*, coalesce(x.n, 0)::BIGINT AS n_repeat_words,
         CASE WHEN n_words > 0 THEN {_distance("cc", "rc")} END AS cd,
         CASE WHEN n_words > 0 THEN {_distance("wc", "rw")} END AS wd
  FROM h LEFT JOIN x USING (doc_id) LEFT JOIN u USING (lang)),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM j)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(
         (n_words >= {m.class_words} AND cd > {m.class_distance}) OR (n_words >= {m.word_words} AND wd > {m.word_distance})
         OR (n_words >= {m.both_words} AND cd > {m.both_class_distance} AND wd > {m.both_word_distance}), false) AS kept
FROM v
"""


QUALITY = _quality()

EMBEDDING_DEDUP = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS s FROM v WHERE list_dot_product(e, e) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.s * b.s) >= {MIN_COSINE}),
reach(v, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.v, l.b FROM reach JOIN l ON l.a = reach.r),
c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(k.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.v = vec_id LEFT JOIN k ON k.a = vec_id
"""


def _merkle(levels: int = 5) -> str:
    """SQL of the manifest for trees of up to 16 ** levels leaves. A node that is alone on
    its level stays as it is, so every tree is carried up to the same level."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', {c}) END"
    fields = [field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = lambda text: "sha256(concat(" + ", ".join([*fields, field(text)]) + "))"
    # checksum of the decimal digits: each byte is followed by eight steps (-1)
    steps = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    crc = f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END))"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [f"""d AS (
  SELECT *, CASE WHEN ({crc}) % 5 = 0 THEN {lower} ELSE text END AS found FROM documents)""", f"""l AS (
  SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('found')} AS claimed FROM d)""", """p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM l)""", """a0 AS (
  SELECT tree, position AS i, leaf AS h FROM p)"""]

    def up(name: str) -> None:
        for k in range(levels):
            out.append(f"{name}r{k} AS (SELECT tree, i // 16 AS i, list(h ORDER BY i) AS hs, count(*) OVER (PARTITION BY tree) AS runs FROM {name}{k} GROUP BY tree, i // 16)")
            out.append(f"{name}{k + 1} AS (SELECT tree, i, CASE WHEN runs = 1 AND len(hs) = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}r{k})")

    up("a")
    out.append(f"b0 AS (SELECT CAST(-1 AS BIGINT) AS tree, tree AS i, h FROM a{levels})")
    up("b")
    out.append("f0 AS (SELECT doc_id, leaf, tree, position, position AS i, claimed AS cur, '' AS proof FROM p)")
    step = 0
    for name in "ab":
        for k in range(levels):
            tree = "f.tree" if name == "a" else "-1"
            place = "CAST(f.i % 16 AS BIGINT)"
            alone = "(r.runs = 1 AND len(r.hs) = 1)"
            before, after = (f"array_to_string(list_slice(r.hs, {x}), '')" for x in (f"1, {place}", f"{place} + 2, 16"))
            out.append(f"""f{step + 1} AS (
  SELECT f.doc_id, f.leaf, f.tree, f.position, f.i // 16 AS i, CASE WHEN {alone} THEN f.cur ELSE sha256(concat({before}, f.cur, {after})) END AS cur,
         CASE WHEN {alone} THEN f.proof ELSE concat(f.proof, {before}, {after}) END AS proof
  FROM f{step} f JOIN {name}r{k} r ON r.tree = {tree} AND r.i = f.i // 16)""")
            step += 1
        if name == "a":
            out.append(f"f{step + 1} AS (SELECT * REPLACE (tree AS i) FROM f{step})")
            step += 1
    return "WITH " + ",\n".join(out) + f"""
SELECT f.doc_id, f.leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM f{step} f JOIN a{levels} s ON s.tree = f.tree CROSS JOIN b{levels} t"""


MERKLE = _merkle()
