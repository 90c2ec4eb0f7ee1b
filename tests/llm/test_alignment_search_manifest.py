"""Tokenizer alignment, graph search and the Merkle manifest against brute force."""

import collections
import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest

from formwork.llm import alignment, graph_search, merkle
from formwork.llm.alignment import RESULTS, align_tokenizers
from formwork.llm.graph_search import Graph, build_index, lifted, lowered, search_index
from formwork.llm.merkle import build_manifest, manifest_proofs, prove, record_hash
from formwork.llm.queries import QUERIES
from formwork.llm.tokens import byte_letters, vocabulary_path

from .helpers import EDGE, edge_frame

SF = "/root/testdata/sf0.001"


def aligned(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text,
    walking both token lists with the libraries' own encoders."""
    import sentencepiece
    from tokenizers import Tokenizer

    fast = Tokenizer.from_file(vocabulary_path(alignment.FIRST))
    fast.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(alignment.SECOND))
    letter = byte_letters()

    def walk(text):
        if not text:
            return None
        a, b = fast.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        of_a = [bytes(letter[c] for c in fast.id_to_token(i)) for i in a]
        of_b = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            return None
        ends = lambda parts: list(itertools.accumulate(map(len, parts)))
        end_a, end_b = ends(of_a), ends(of_b)
        both = sorted(set(end_a) & set(end_b))
        i = j = 0
        groups, links = [], []
        for e in both:
            ga, gb = [], []
            while i < len(a) and end_a[i] <= e:
                ga.append(i)
                i += 1
            while j < len(b) and end_b[j] <= e:
                gb.append(j)
                j += 1
            links += [(a[x], b[y]) for x in ga for y in gb if end_a[x] - len(of_a[x]) < end_b[y] and end_b[y] - len(of_b[y]) < end_a[x]]
            groups.append(",".join(str(a[x]) for x in ga) + "|" + ",".join(str(b[y]) for y in gb))
        return len(a), len(b), groups, links

    walked = [walk(t) for t in texts]
    counts = collections.Counter(p for w in walked if w for p in w[3])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (w[0], w[1], len(w[2]), len(w[3]), sum(counts[p] == best[p[1]] for p in w[3]), sum(counts[p] for p in w[3]), hashlib.sha256(";".join(w[2]).encode()).hexdigest()) if w else (0, 0, 0, 0, 0, 0, "")
        for w in walked
    ]


ODD = ["", " ", "  two  blanks ", "tab\tline\nend\n", "▁ lower bar", "<|endoftext|> and <s> as text", "日本語 text ünï \U0001f469‍\U0001f680", "a\x00b", "\x85 x", "don't you'll 12345,678", "é" * 300, "x" * 5000]


@pytest.mark.parametrize("chars,hot", [(alignment.BLOCK_CHARS, alignment.HOT_LEAST), (40, 2)])
def test_alignment_against_brute_force(spark, chars, hot):
    rng = random.Random(3)
    words = "the a of zzyx Haus straße número l'été 42 and, or;".split(" ")
    texts = [*ODD, *[" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(60)]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[20]) for i in range(30)] + [(7, texts[7]), (7, texts[7]), (None, texts[9]), (2000, None), (2001, texts[30] + "!")]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, n_a string")
    got = align_tokenizers(frame, block_chars=chars, hot_least=hot).collect()
    want = [(i, *m) for (i, _), m in zip(rows, aligned([t for _, t in rows]))]
    key = lambda r: str(r)
    assert sorted((tuple(r[c] for c in ("doc_id", *RESULTS)) for r in got), key=key) == sorted(want, key=key)
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups for r in got)


def test_alignment_of_edge_rows(spark):
    got = align_tokenizers(edge_frame(spark))
    assert {"n_words", "kept", "label"} <= set(got.columns) and len(got.columns) == len(set(got.columns))
    want = [(i, *m) for (i, _), m in zip(EDGE, aligned([t for _, t in EDGE]))]
    assert sorted((tuple(r[c] for c in ("doc_id", *RESULTS)) for r in got.collect()), key=str) == sorted(want, key=str)
    assert align_tokenizers(edge_frame(spark).limit(0)).collect() == []
    nothing = align_tokenizers(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in nothing) == [(i, t, 0, 0, 0, 0, 0, 0, "") for i, t in ((1, None), (2, ""))]


def nearest(rows, queries, k):
    """Exact results: (query, rank, id, score)."""
    ok = lambda v: v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)
    points = sorted({(i, tuple(v)) for i, v in rows if i is not None and ok(v)})
    out = []
    for q, v in sorted({(i, tuple(v)) for i, v in queries if i is not None and ok(v)}):
        near = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, x in points if i != q and len(x) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return out


def test_search_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-4, 5, (40, 8)).astype(float)
    rows = [(i, base[i % 40].tolist()) for i in range(200)]  # five copies of each vector
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [-0.0] * 8), (304, [math.nan] * 8), (305, [math.inf, *[1.0] * 7]), (306, [None, *[1.0] * 7]), (307, [1.0, 2.0]), (308, [2.0, 1.0]), (None, base[0].tolist()), rows[3], rows[3], (400, (base[1] * 3).tolist())]
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], "vec_id long, embedding array<double>, rank string, score string")
    queries = frame.where("vec_id % 5 = 0 or vec_id >= 300 or vec_id is null")
    asked = [r for r in rows if r[0] is None or r[0] % 5 == 0 or r[0] >= 300]
    for shard, block in ((graph_search.SHARD, graph_search.QUERY_BLOCK), (12, 7)):
        got = search_index(build_index(frame, shard=shard), queries, query_block=block).collect()
        assert sorted(tuple(r) for r in got) == nearest(rows, asked, 20)
    small = search_index(build_index(frame.where("vec_id < 6")), frame.where("vec_id < 6"))
    assert sorted(tuple(r) for r in small.collect()) == nearest(rows[:6] , rows[:6], 20)
    assert search_index(build_index(frame.limit(0)), queries).collect() == []
    assert search_index(build_index(frame), queries.limit(0)).collect() == []


def test_search_recall_and_work():
    """Recall of at least 0.95 at a part of the distances that all pairs would take, on
    clustered vectors of different lengths; every point can be reached."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((30, 24))[rng.integers(0, 30, 4000)] + 0.5 * rng.standard_normal((4000, 24))
    x *= rng.uniform(0.5, 2, (4000, 1))
    graph = Graph.build(lifted(x))
    assert graph.reachable().all() and (graph.edges >= 0).sum(axis=1).max() <= graph_search.DEGREE + graph_search.SLACK
    q = x[::40]
    found, near, steps = graph.search(lowered(q), graph_search.SEARCH_BEAM)
    best = np.argsort(-(q @ x.T), axis=1)[:, :20]
    recall = np.mean([len(set(f.tolist()) & set(b.tolist())) / 20 for f, b in zip(found, best)])
    assert recall >= 0.95 and steps < 0.6 * len(q) * len(x)
    assert (np.diff(near, axis=1) >= 0).all()


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1], [-3, 0]], np.float32)
    graph = Graph(points, np.full((6, 4), -1, np.int32), 0)
    near = ((points[1:] - points[0]) ** 2).sum(axis=1)[None] - graph.square[0]
    order = np.argsort(near[0])
    kept = graph._pruned(np.array([0]), np.arange(1, 6)[order][None], near[:, order], 4, 1.2)
    assert kept.tolist() == [[1, 3, 5, -1]]  # 2 and 4 lie behind 1 and 3


def test_search_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op12_nearest_neighbours"](spark, SF).collect()
    want = nearest(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert len(got) == len(want)
    exact = {(q, i): s for q, _, i, s in nearest(rows, [r for r in rows if r[0] % 20 == 0], len(rows))}
    assert all(math.isclose(exact[r.query_id, r.vec_id], r.score, rel_tol=1e-12) for r in got)
    assert len({(r.query_id, r.vec_id) for r in got} & {(q, i) for q, _, i, _ in want}) >= 0.95 * len(want)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, now):
    """(id, leaf, subroot, root, proof, folded root) of every (id, group, text)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, g, t: h(field(i), field(g), field(t))
    groups = {}
    for i, g, t in rows:
        groups.setdefault(g, []).append(((i is not None, i or 0), leaf(i, g, t), i, leaf(i, g, now(i, t))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][a : a + 16]) for a in range(0, len(out[-1]), 16)])
        return out

    trees = {g: levels([x[1] for x in sorted(groups[g])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for p, (_, x, i, claimed) in enumerate(sorted(groups[g])):
            proof = []
            for at, tree in ((p, trees[g]), (n, top)):
                for level in tree[:-1]:
                    run, k = level[at // 16 * 16 : at // 16 * 16 + 16], at % 16
                    proof += run[:k] + run[k + 1 :]
                    claimed = h(*run[:k], claimed, *run[k + 1 :])
                    at //= 16
            out.append((i, x, trees[g][-1][0], top[-1][0], h(*proof), claimed, claimed == top[-1][0], proof))
    return out


@pytest.mark.parametrize("deep", [merkle.DEEP, 1])
def test_manifest_against_brute_force(spark, deep):
    rows = [(i, "hot", f"Text {i}") for i in range(700)] + [(i, f"g{i % 37}", f"Été {i}") for i in range(700, 900)]
    rows += [(5000, None, "x"), (None, "hot", "no id"), (None, None, None), (1, "hot", "Text 1"), (1, "hot", "Text 1"), (6000, "", ""), (6001, "", None), (6002, "Ω", "y"), (6003, "\U0001f600", "z")]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], "doc_id long, source string, text string, leaf string, block string")
    from pyspark.sql import functions as F

    now = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    lower = lambda i, t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t) if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t
    got = manifest_proofs(frame, "doc_id", "source", ["doc_id", "source", "text"], {"text": now}, siblings=True, deep=deep).collect()
    columns = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "siblings")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == sorted(manifest(rows, lower), key=str)
    assert {r.verified for r in got} == {True, False}


def test_multiproof_of_some_leaves(spark):
    """A few leaves of a partition fetch the lower nodes they lack, and nothing else."""
    rows = [(i, "a" if i < 300 else "b", f"t{i}") for i in range(420)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    from pyspark.sql import functions as F

    made = build_manifest(frame.withColumn("leaf", record_hash([F.col("doc_id"), F.col("source"), F.col("text")])), "doc_id", "source", "leaf")
    some = {3, 4, 200, 419}
    got = prove(made, made.leaves.where(F.col("id").isin(*some)), siblings=True).collect()
    want = {w[0]: w for w in manifest(rows, lambda i, t: t)}
    assert {r.id for r in got} == some
    assert all((r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.siblings) == want[r.id] for r in got)
    assert merkle.missing({3, 4}, 40, 0) == [(0, 0, i) for i in range(16) if i not in (3, 4)] + [(0, 1, 1), (0, 1, 2)]
    assert merkle.missing({0}, 1, 0) == [] and merkle.missing(set(range(40)), 40, 0) == []


def test_manifest_of_one_and_no_row(spark):
    one = spark.createDataFrame([(1, "s", "t")], "doc_id long, source string, text string")
    (r,) = manifest_proofs(one, "doc_id", "source", ["text"]).collect()
    assert r.leaf == h("1:t") == r.subroot == r.root == r.folded_root and r.verified and r.proof_sha256 == h("")
    assert manifest_proofs(one.limit(0), "doc_id", "source", ["text"]).collect() == []
