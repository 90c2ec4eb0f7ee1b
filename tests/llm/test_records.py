"""Vectors, components, captures, the pipeline and the SQL of the queries."""

import math
import random
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from formwork.llm import personal_data
from formwork.llm.embedding_dedup import link_vectors
from formwork.llm.frames import BATCH_BYTES, small_batches
from formwork.llm.graph import components, roots
from formwork.llm.minhash_dedup import _KEYS, _pressed, _signed
from formwork.llm.packing import token_encoder
from formwork.llm.queries import ORACLE, QUERIES
from formwork.llm.revisits import resolve_revisits
from formwork.llm.substring_dedup import _packed, _send_windows
from formwork.llm.tokens import vocabulary_path

from .helpers import classes, quality, removed_words

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages")


def test_components(spark):
    rng = random.Random(9)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 200), (300, 301), (301, 300), (300, 301)]
    rng.shuffle(pairs)
    frame = spark.createDataFrame([*pairs, (None, 5), (400, None)], "a long, b long")
    got = {r.vertex: r.component for r in components(frame, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 300: 300, 301: 300}
    assert components(frame.limit(0), "a", "b").collect() == []
    assert roots(5, np.array([4, 2]), np.array([2, 1])).tolist() == [0, 1, 1, 3, 1]


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(10)
    base = rng.standard_normal((6, 16))
    rows = []
    for i in range(240):
        v = base[i % 6] + rng.standard_normal(16) * rng.choice([0.05, 0.15, 0.3])
        rows.append((i, v.tolist(), int(i % 3)))
    rows += [(300, rows[0][1], 0), (301, rows[0][1], 0), (302, rows[0][1], None), (303, None, 1), (304, [0.0] * 16, 1), (305, [math.nan] * 16, 1), (306, [None, 1.0], 1), (307, [], 1), (308, (np.array(rows[1][1]) * 1e200).tolist(), 1), (309, rows[4][1][:3], 1), (310, [math.inf] * 16, 1), (0, rows[0][1], 0)]
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], "vec_id long, embedding array<double>, label int, rep string, kept string")
    usable = [(i, np.array(v) / np.abs(v).max(), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    n = len(usable)
    linked = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            x, y = usable[a][1], usable[b][1]
            linked[a, b] = a != b and usable[a][2] == usable[b][2] and len(x) == len(y) and x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= 0.93
    root = list(range(n))
    for _ in range(n):
        new = [min([root[a], *[root[b] for b in np.flatnonzero(linked[a])]]) for a in range(n)]
        if new == root:
            break
        root = new
    low = {}
    for a in range(n):
        low[root[a]] = min(low.get(root[a], 10**9), usable[a][0])
    want = sorted([(usable[a][0], int(linked[a].sum()), low[root[a]], usable[a][0] == low[root[a]]) for a in range(n)] + [(i, 0, i, True) for i in (302, 303, 304, 305, 306, 307, 310)])
    for block in (1024, 8):  # hot keys split into blocks
        got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in link_vectors(frame, block=block).collect())
        assert got == want
    assert link_vectors(frame.limit(0)).collect() == []


HEADERS = {"ETag": '"a"', "Content-Type": "text/html", "X": "1"}


def test_revisits(spark):
    rows = [
        (1, "http://www.a.com/x/?b=2&a=1&utm_source=q#f", 10, "response", HEADERS, "d1"),
        (2, "https://A.com:443/x?a=1&b=2", 20, "response", {"Last-Modified": "mon", "Content-Type": "t", "Expires": "e"}, "d2"),
        (3, "https://A.com:443/x?a=1&b=2", 20, "response", {"etag": 'W/"z"'}, "d3"),
        (10, "http://a.com/x?b=2&a=1", 15, "revisit", {"etag": 'W/"a"', "content-type": "other", "X": "2"}, None),
        (11, "http://a.com/x?b=2&a=1", 10, "revisit", {}, None),  # not earlier
        (12, "http://a.com/x?b=2&a=1", 25, "revisit", {"etag": '"q"'}, None),  # of two at one time the greater id
        (13, "http://a.com/x?b=2&a=1", 25, "revisit", None, "d3"),
        (14, "http://a.com/x?b=2&a=1", 25, "revisit", None, None),
        (15, None, 25, "revisit", None, None), (16, "  ", 25, "revisit", None, None), (17, "http://a.com/x", None, "revisit", None, None),
        (18, "http://b.com", 5, "revisit", {"last-modified": "x"}, None), (18, "http://b.com", 5, "revisit", {"last-modified": "x"}, None),
        (19, "http://a.com/x?b=2&a=1", 25, "request", None, None), (20, "http://a.com/x?b=2&a=1", 15, "revisit", {"Last-Modified": "tue"}, "d1"),
    ]
    schema = "record_id long, url string, time long, type string, headers map<string,string>, digest string, status string, key string"
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], schema)
    got = resolve_revisits(frame).collect()
    assert sorted((r.record_id, r.target_id, r.status) for r in got if r.record_id != 18) == [
        (10, 1, "resolved"), (11, None, "no_response"), (12, 3, "mismatch"), (13, 3, "resolved"), (14, 3, "unchecked"), (15, None, "no_url"), (16, None, "no_url"), (17, None, "no_time"), (20, 1, "mismatch")]
    assert [r.status for r in got if r.record_id == 18] == ["no_response"] * 2
    merged = {r.record_id: [tuple(h) for h in r.headers] for r in got}
    assert merged[10] == [("content-type", "text/html"), ("etag", 'W/"a"'), ("x", "2")] and merged[13] == [("etag", 'W/"z"')] and merged[14] == merged[13]
    assert resolve_revisits(frame.limit(0)).collect() == []


def test_revisits_of_one_hot_url(spark):
    rng = random.Random(11)
    rows = [(i, "http://h.com/", rng.randrange(3000), rng.choice(("response", "revisit")), None, None) for i in range(3000)]
    frame = spark.createDataFrame(rows, "record_id long, url string, time long, type string, headers map<string,string>, digest string")
    responses = sorted((t, i) for i, _, t, k, _, _ in rows if k == "response")
    want = {i: max((r for r in responses if r[0] < t), default=(None, None))[1] for i, _, t, k, _, _ in rows if k == "revisit"}
    assert {r.record_id: r.target_id for r in resolve_revisits(frame).collect()} == want


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = con.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    want = sorted((tuple(dict(zip(relation.columns, r))[c] for c in columns) for r in relation.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str) == want


def test_every_operator_has_a_query():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.orderBy("doc_id").collect()]
    rows = [r for r, q in zip(rows, quality([(t, lang) for _, t, lang in rows])) if q[-1]]
    rows = [r for r, c in zip(rows, classes([(i, t) for i, t, _ in rows])) if r[0] == c]
    kept = removed_words([t for _, t, _ in rows])
    got = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        got = stage(spark, got, SF)
        assert got.columns == docs.columns, name
        if n == 2:
            assert {r.doc_id: r.text.encode().split() for r in got.collect()} == {i: k for (i, _, _), (k, _) in zip(rows, kept)}
            texts = {r.doc_id: r.text for r in got.collect()}
            model = personal_data.fit_model(got)
    want = {i: personal_data.mask(t, personal_data.all_spans(t, model)) for i, t in texts.items()}
    assert {r.doc_id: r.text for r in got.collect()} == want
    packed = corpus_pipeline.run(spark, SF).collect()
    encode = token_encoder(vocabulary_path())
    tokens = {i: encode(t) + bytes(4) for i, t in want.items()}
    pieces = {}
    for r in sorted(packed, key=lambda r: r.piece):
        pieces[r.doc_id] = pieces.get(r.doc_id, b"") + r.ids
    assert {i: zlib.crc32(x) for i, x in pieces.items()} == {i: zlib.crc32(x) for i, x in tokens.items()}
    used = {}
    for r in packed:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in places) <= 2048 for places in used.values())


def test_packing_workers_hold_no_texts():
    encode = token_encoder(vocabulary_path())
    encode("the first text")
    tracemalloc.start()
    for i in range(20):
        encode(" ".join(f"own{i}word{k}" for k in range(1000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 200_000


def test_pipeline_stages_send_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(1, "a few words only", "en", "s", 16)], "doc_id long, text string, lang string, source string, n_chars long")
    large = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('word ', 1000) text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, SF)
            sent = [r.n for r in large.mapInArrow(sizes, "n long").collect()]
            assert sum(sent) > 3 * BATCH_BYTES and max(sent) < 1.5 * BATCH_BYTES, name
        spark.conf.set(key, "1m")
        small_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


def test_workers_give_back_memory_of_batches(monkeypatch):
    given = []

    class Pool:
        def release_unused(self):
            given.append(True)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    text = " ".join(f"w{i}" for i in range(100))
    ids, digests, texts = pa.array([1]), pa.array([b"d"]), pa.array([text])
    for run, columns in ((_signed(5, 20, 4), [ids, digests, texts]), (_pressed, [digests, texts]), (_send_windows(35, 32), [ids, texts]), (_packed, [ids, texts])):
        out = run(iter([pa.RecordBatch.from_arrays(columns, names=_KEYS.names[: len(columns)])]))
        assert next(out).num_rows and not given
        list(out)
        assert given.pop() and not given


def test_pipeline_takes_clashing_columns(spark):
    docs = spark.createDataFrame([(1, " ".join(f"the w{i} of x{i}" for i in range(30)), "en", "s", 9, "own", "own"), (2, None, "en", "s", 0, "own", "own")], "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert [(r.doc_id, r.kept, r.n_words) for r in docs.collect()] == [(1, "own", "own")]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
