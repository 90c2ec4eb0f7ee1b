"""Operators over whole texts: rows of every awkward kind, and brute-force versions."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from formwork.llm import licenses, personal_data, secrets
from formwork.llm.bpe_automaton import codec, encode_decode
from formwork.llm.minhash_dedup import _only_near, drop_near_duplicates, near_duplicates
from formwork.llm.packing import best_fit_pack, cut_lengths, plan, sequences, token_pieces
from formwork.llm.quality import judge_quality
from formwork.llm.substring_dedup import _BASES, _PRIME, WindowHasher, _block_rows, _count_bucket, remove_repeated_passages
from formwork.llm.tokens import vocabulary_path

from .helpers import EDGE, LONG, classes, edge_frame, personal, quality, removed_words, secret

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")


@pytest.mark.parametrize("operator", [encode_decode, judge_quality, licenses.scan_licenses, personal_data.find_personal_data, secrets.find_secrets, token_pieces, remove_repeated_passages, near_duplicates, drop_near_duplicates])
def test_empty_tables_and_clashing_names(spark, operator):
    none = operator(edge_frame(spark, []))
    assert none.collect() == []
    names = [c.lower() for c in operator(edge_frame(spark)).columns]
    assert len(names) == len(set(names))


def test_substring_dedup(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [*EDGE, (10, f"head {shared} tail"), (11, f"other\n{shared}  end"), (12, " ".join(["same"] * 40)), (13, shared[:100])]
    frame = edge_frame(spark, rows)
    got = remove_repeated_passages(frame).collect()
    want = removed_words([t for _, t in rows])
    expected = sorted((str(i), n + len(kept), n, b" ".join(kept).decode()) for (i, _), (kept, n) in zip(rows, want))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == expected
    assert all(r.row == "own" and r.bucket == "own" for r in got)
    by = {r.doc_id: r for r in remove_repeated_passages(frame, layout="text").collect()}
    assert by[11].kept_text == "other  end" and [tuple(x) for x in by[11].removed] == [(1, 61)]
    assert by[5].kept_text == "a few plain words only" and by[1].n_words == 0


def test_substring_dedup_small_buckets_and_blocks(spark, monkeypatch):
    """Results do not depend on how windows are packed."""
    docs = documents(spark)
    key = lambda df: sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect())
    assert key(remove_repeated_passages(docs)) == key(remove_repeated_passages(docs.repartition(7), bucket_windows=500))


def test_substring_dedup_of_built_words(spark):
    """Words and windows on which polynomials modulo a power of two agree."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"r{i}" for i in range(34))
    signs = ["p" if c == "a" else "q" for c in word[:64]]
    rows = [(1, f"{word} {rest}"), (2, f"{other} {rest}"), (3, " ".join(signs)), (4, " ".join("q" if c == "p" else "p" for c in signs))]
    got = {r.doc_id: r.n_removed for r in remove_repeated_passages(edge_frame(spark, rows)).collect()}
    want = removed_words([t for _, t in rows])
    assert got == {i: n for (i, _), (_, n) in zip(rows, want)} and got[1] == got[2] == 0


def test_window_hashes_are_polynomials_modulo_a_prime():
    for window in (1, 2, 5, 35):
        hasher = WindowHasher(window)
        words = hasher.words(b" ".join(b"w%d" % (i * i % 31) for i in range(80)))[1]
        for lane, base in enumerate(_BASES):
            want = [sum(int(w) * pow(base, window - 1 - k, _PRIME) for k, w in enumerate(words[a : a + window])) % _PRIME for a in range(81 - window)]
            assert hasher.polynomial(words, lane).tolist() == want


def test_places_of_equal_rows_do_not_grow_with_their_number():
    """Rows with one id and text share a list of places, however many there are."""

    def places(copies):
        hasher = WindowHasher(35)
        h, check = hasher.keys(hasher.words(b" ".join(b"w%d" % i for i in range(500)))[1])
        n = len(h)
        rows = list(_block_rows(np.tile(h, copies), np.tile(check, copies), np.full(n * copies, 7), np.tile(np.arange(n, dtype=np.uint32), copies), 8))
        frame = pd.DataFrame(rows, columns=["bucket", "hashes", "checks", "many", "places"])
        return sum(len(x) for _, group in frame.groupby("bucket") for x in _count_bucket(group)["at"])

    assert places(2) == places(50) == 4 * 466
    assert places(1) == 0


def test_quality_against_brute_force(spark):
    lang = lambda n: "en" if n % 2 else None
    rows = [*EDGE, (9, "the the the\nthe the the\n\nof of | # $ and"), (10, ("| tab # le " * 30)), (11, " ".join(f"the w{i} of x{i}" for i in range(90)))]
    got = judge_quality(edge_frame(spark, rows)).collect()
    want = quality([(t, lang(n)) for n, (_, t) in enumerate(rows)])
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted((str(r.doc_id), *[r[f] for f in fields]) for r in got) == sorted((str(i), *w) for (i, _), w in zip(rows, want))


def test_quality_filter_keeps_the_plan_small(spark):
    plan_text = judge_quality(documents(spark)).where("kept").select("doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan_text) < 200_000 and "Python" not in plan_text


@pytest.mark.parametrize("size", [{"block": 8}, {"block_bytes": 12_000}])
def test_minhash_against_all_pairs(spark, size):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(300)]
    family = []
    for k in range(40):  # copies of one text, some too far from it, chained to others
        words = list(base)
        for _ in range(rng.choice((1, 3, 6, 12, 18))):
            words[rng.randrange(300)] = f"n{rng.random()}"
        family.append((100 + k, " ".join(words)))
    rows = [*EDGE, *family, (200, "one two three"), (201, "one  two\nthree"), (202, "one two four"), (203, family[0][1])]
    got = near_duplicates(edge_frame(spark, rows), **size).collect()
    want = classes(rows)
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == sorted((str(i), str(c), i == c) for (i, _), c in zip(rows, want))


def test_bitmap_lets_every_needed_text_through(spark):
    rows = spark.range(5000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("d"), "id")
    needed = rows.where("id % 7 = 0").select("d")
    got = {r.id for r in _only_near(rows, needed).collect()}
    assert got >= set(range(0, 5000, 7)) and len(got) < 730
    assert _only_near(rows, needed.limit(0)).count() == 0


def test_minhash_on_documents(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == dict(zip([i for i, _ in rows], classes(rows)))


def test_drop_near_duplicates_keeps_one_row(spark):
    rows = [*EDGE, (20, LONG), (21, "q r s t u v w")]
    kept = drop_near_duplicates(edge_frame(spark, rows))
    assert kept.columns == edge_frame(spark, []).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, None, 21]))


def test_drop_near_duplicates_missing_and_shared_ids(spark):
    other = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcde"]
    near = other[4] + " tail"
    rows = [(1, LONG), (None, LONG), (None, other[0]), (None, other[1]), (None, other[1]), (2, other[2]), (3, other[2]), (3, other[3]), (None, other[4]), (None, near)]
    kept = sorted((str(r.doc_id), r.text) for r in drop_near_duplicates(edge_frame(spark, rows)).collect())
    last = [t for i, t in kept if t in (other[4], near)]
    assert len(last) == 1
    assert kept == sorted([("1", LONG), ("None", other[0]), ("None", other[1]), ("2", other[2]), ("3", other[3]), ("None", last[0])])


def test_personal_patterns_against_brute_force():
    rng = random.Random(5)
    parts = [*"0123456789.@ab+-() é", "12", "255", "256", "1.2.3.4", "4111111111111111", "a@b.c", "+1 (456) 555-2186"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        assert personal_data.pattern_spans(t) == personal(t), t


def test_personal_data_operator(spark):
    rows = [*EDGE, *[(100 + i, f"write to user{i}.x@mail{i}.example.com or +1 ({200 + i}) 555-{2000 + i} from 10.2.3.{i} now please, {LONG[:300]}") for i in range(120)], (300, "card 4111 1111 1111 1111 and name [at] mail3.example.com")]
    got = {r.doc_id: r for r in personal_data.find_personal_data(edge_frame(spark, rows)).collect()}
    for i, t in rows:
        base = [(s.kind, s.start, s.end) for s in got[i].spans if s.base]
        assert base == personal(t or "")
    assert got[1].masked_text == "" and got[1].spans == [] and got[4].masked_text == LONG
    assert got[100].masked_text.startswith("write to [email] or [phone] from [ip] now please")


def test_semi_markov_learns_what_patterns_miss():
    texts = [f"some words user{i}.y@mail{i}.example.com then more words here" for i in range(150)]
    model = personal_data.SemiMarkov().fit(personal_data.training_data(texts))
    text = "ask joe.doe [at] mail8.example.com for more"
    assert [(k, text[a:b]) for k, a, b, base in personal_data.all_spans(text, model) if not base] == [("email", "joe.doe [at] mail8.example.com")]
    assert personal_data.all_spans("meet at 10.30 with 3 of 4 and 5", model) == []
    assert personal_data.all_spans("x@y", personal_data.SemiMarkov()) == []


def test_spelt_out_addresses_without_a_digit():
    texts = [f"some words user{i}.y@mail{i}.example.com then more words here" for i in range(150)]
    model = personal_data.SemiMarkov().fit(personal_data.training_data(texts))
    for address in ("joe [at] example.com", "joe(at)example.com", "joe at example dot com", "joe.doe [AT] mail.example.com"):
        text = f"{'plain words and ' * 20}ask {address} for more{' plain words and' * 20}"
        assert [(k, text[a:b], base) for k, a, b, base in personal_data.all_spans(text, model)] == [("email", address, False)], address
    assert personal_data.all_spans("we meet at noon (at home) at the dot of nine", model) == []


def test_semi_markov_gradient_and_best_path():
    """The gradient is that of the likelihood; the best path is the best of all."""
    p = next(personal_data.passages("id 10.2.3.4 and 4111111111111111 or a@b.cd"))
    arcs = [(i, j, personal_data.features(p, i, j, k), n % 3 == 0) for n, (i, j, k) in enumerate(personal_data.candidates(p))][:12]
    model = personal_data.SemiMarkov({f: 0.1 * (len(f) % 7 - 3) for _, _, fs, _ in arcs for f in fs})
    n = len(p.spans)

    def log_total(m):
        ends = [0.0] + [0.0] * n
        for j in range(1, n + 1):
            ends[j] = personal_data._log_sum([ends[j - 1], *[ends[i] + m.score(fs) for i, e, fs, _ in arcs if e == j]])
        return ends[n]

    grad = model._gradient(n, arcs)
    f = arcs[0][2][0]
    step = 1e-5
    up = personal_data.SemiMarkov(model.weights | {f: model.weights[f] + step})
    observed = sum(g * fs.count(f) for _, _, fs, g in arcs)
    assert abs(observed - (log_total(up) - log_total(model)) / step - grad[f]) < 1e-3


def test_secret_patterns_against_brute_force():
    rng = random.Random(6)
    parts = ["password", "TOKEN", "api_key", "ApiKey", "=", ":", " ", '"', "'", "AKIA", "ABCDEF123456", "0a1b2c3d" * 4, "x", "Zz9+/", "secret", "sſecret", "passwd"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert sorted(secrets.pattern_spans(t)) == sorted(secret(t)), t


def test_guess_costs_and_contexts(spark):
    cheap, dear = ("password1", "letmein2019", "qwertyuiop", "aaaaaaaaaa", "20191231", "P@ssw0rd", "abcdefgh1234"), ("7b7aa4a5fcc78305", "Xk9$mQ2!vL7z", "zq8LmW0pRt")
    assert max(map(secrets.guess_cost, cheap)) < secrets.MIN_GUESSES < min(map(secrets.guess_cost, dear))
    assert secrets.guess_cost("") == 0
    rows = [*EDGE, (20, "the pwd is Xk9$mQ2!vL7z today"), (21, "passphrase: letmein2019"), (22, 'password = "abcdefgh1"')]
    got = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in secrets.find_secrets(edge_frame(spark, rows)).collect()}
    assert got[20] == [("guess", 11, 23, False)] and got[21] == [] and got[22] == [("assign", 0, 21, True)] and got[1] == []


def test_secrets_of_letters_and_beside_patterns():
    found = lambda t: [t[a:b] for kind, a, b, _, _ in secrets.all_spans(t) if kind == "guess"]
    for name, value in (("pwd: ", "QzXwVtRnKpLmHdJs"), ("passphrase = ", "kTqWzVbNxRp"), ("password is ", "XkQzVwTnBrLp")):
        assert found(f"the {name}{value} here") == [value]
    for value in ("required", "authentication", "whatever", "REQUIRED", "Elephants", "mandatory", "misunderstood", "forgotten", "confidential"):
        assert found(f"pin: {value} and password is {value}.") == [], value
    assert found("api_key=ABCDEFGH12&pwd=Xk9$mQ2!vL7z") == ["Xk9$mQ2!vL7z"]
    assert found("pwd=Xk9$mQ2!vL7z&api_key=ABCDEFGH12&pwd=zq8LmW0pRt") == ["Xk9$mQ2!vL7z", "zq8LmW0pRt"]


def test_guess_cost_of_a_long_value():
    tail = "Xk9$mQ2!vL7z"
    assert secrets.guess_cost("a" * 300) < secrets.MIN_GUESSES < secrets.guess_cost("a" * 300 + tail)
    assert [s[0] for s in secrets.all_spans(f"pwd: {'=' * 300}{tail}")] == ["guess"]


def test_licenses(spark):
    apache = licenses.TEMPLATES["Apache-2.0"][0]
    text = f"words before\n{apache} {LONG[:4000]}\nReleased under the MIT License.\nLicensed under the Apache License, Version 1.1.\nReleased under the terms of MIT License"
    rows = [*EDGE, (30, text), (31, "Licensed under CC BY-NC 4.0. Licensed under CC BY-SA 4.0."), (32, "licence and copyright in plain words")]
    got = {r.doc_id: [(n.license, text[n.start : n.end] if r.doc_id == 30 else "") for n in r.notices] for r in licenses.scan_licenses(edge_frame(spark, rows)).collect()}
    assert [n for n, _ in got[30]][:2] == ["Apache-2.0", "MIT"] and got[30][0][1] == apache[:-1] and all(n != "Apache-2.0" for n, _ in got[30][1:])
    assert [n for n, _ in got[31]] == ["CC-BY-NC-4.0", "CC-BY-SA-4.0"] and got[32] == [] and got[1] == []
    assert licenses.savings(apache)[0][1].name == "Apache-2.0"
    spaced = licenses.find_notices("This work is licensed under the terms of the GNU General Public License, version 3.")
    assert spaced[0][0] == "GPL-3.0" and spaced[0][5] == ["the", "terms", "of"]


def test_licenses_behind_near_misses():
    """Near misses, however many, hide no notice of their block."""
    miss = "This work is licensed under the GNU General Public License, version 1."
    mit = "Released under the MIT License."
    for text in (f"{miss}\n{mit}", f"{mit}\n{miss}", "\n".join([miss] * 50 + [mit] + [miss.replace("1", "7")] * 50)):
        assert [(n[0], text[n[1] : n[2]]) for n in licenses.find_notices(text)] == [("MIT", mit[:-1])]
    wordings = [(name, t) for name, ts in licenses.TEMPLATES.items() for t in ts]
    text = "\n".join(f"{t} {miss}" for _, t in wordings)
    assert [n[0] for n in licenses.find_notices(text)] == [name for name, _ in wordings]
    gpl = licenses.TEMPLATES["GPL-3.0"][0]
    assert [n[0] for n in licenses.find_notices(f"{gpl.replace('3', '4')} {gpl} {gpl.replace('3', '5')}")] == ["GPL-3.0"]


def test_licenses_are_confirmed_in_the_order_of_savings():
    """Of wordings that share their place, the one that saves most bytes is reported, and
    all differences from it are the exact ones."""
    rng = random.Random(8)
    every = licenses.templates()
    for name, wordings in licenses.TEMPLATES.items():
        for text in wordings:
            words = text.split()
            plain = [k for k, w in enumerate(words) if k and not any(licenses._telling(x) for x, _, _ in licenses.words_of(w))]
            for extra in (None, rng.choice(plain)):
                changed = words if extra is None else [*words[:extra], "verily", *words[extra:]]
                block = " ".join(changed)
                found = licenses.find_notices(block)
                ranked = licenses.savings(block)
                assert len(ranked) == len(every) and [x for x, _ in ranked] == sorted((x for x, _ in ranked), reverse=True)
                first = next(t for _, t in ranked if licenses.confirm(t, licenses.words_of(block)))
                assert found[0][0] == first.name == name and found[0][3] == dict((id(t), x) for x, t in ranked)[id(first)]
                assert found[0][4:] == ([], [] if extra is None else ["verily"])


def test_bpe_against_the_library(spark):
    own, other = codec(vocabulary_path()), Tokenizer.from_file(vocabulary_path())
    rng = random.Random(7)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "23", "中", "\x1c", "\x85", "\U0001f600", "'s", "'ll", "the", "aaa", "<|endoftext|>", "_", "Ⅷ", "̀", "\x00", "!!!", "ing", "https", "\r\n"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        ids = own.encode(t)
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == other.encode(t, add_special_tokens=False).ids, t
        assert own.decode(ids) == t
    got = encode_decode(edge_frame(spark)).collect()
    for r in got:
        assert r.decoded == (r.text or "") and r.n_tokens == len(other.encode(r.text or "", add_special_tokens=False).ids)


def test_plan_places_every_piece():
    rng = random.Random(8)
    for capacity, n in ((1, 3), (7, 40), (100, 500), (2048, 3000)):
        counts = {}
        for _ in range(n):
            size = min(capacity, int(rng.paretovariate(0.7) * capacity / 30) + 1) if rng.random() < 0.5 else rng.randint(1, capacity)
            counts[size] = counts.get(size, 0) + 1
        bins = plan(counts, capacity)
        placed = {}
        for b in bins:
            assert sum(s * k for s, k in b.runs) + b.gap == capacity and b.gap >= 0
            assert sum(k for s, k in b.runs if 3 * s > capacity) <= 2
            for s, k in b.runs:
                placed[s] = placed.get(s, 0) + k * b.n
        assert placed == counts
        assert sum(b.n for b in bins) <= 1.02 * sum(s * k for s, k in counts.items()) / capacity + sum(3 * s > capacity for s in counts) + 1
    assert plan({}, 10) == [] and cut_lengths(5000, 2048) == [904, 2048, 2048] and cut_lengths(4096, 2048) == [2048, 2048]


def test_packing(spark):
    frame = edge_frame(spark)
    pieces = token_pieces(frame, capacity=64)
    packed = best_fit_pack(pieces, ["doc_id", "piece"], capacity=64).collect()
    other = Tokenizer.from_file(vocabulary_path())
    assert sum(r.length for r in packed) == sum(len(other.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in EDGE)
    used = {}
    for r in packed:
        assert len(r.ids) == 4 * r.length
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    whole = sequences(best_fit_pack(pieces, ["doc_id", "piece"], capacity=64)).collect()
    assert len(whole) == len(used) and all(len(r.ids) <= 256 for r in whole)
    assert best_fit_pack(spark.createDataFrame([], "doc_id long, piece int, length long"), ["doc_id", "piece"]).collect() == []
    with pytest.raises(ValueError):
        best_fit_pack(spark.createDataFrame([(1, 0, 0)], "doc_id long, piece int, length long"), ["doc_id", "piece"])




def test_secrets_in_quotes_and_before_spans():
    found = lambda t: [t[a:b] for kind, a, b, _, _ in secrets.all_spans(t) if kind == "guess"]
    for mark in "&|/;,":
        assert found(f"pwd=Xk9$mQ2!vL7z{mark}token=ABCDEFGH12") == ["Xk9$mQ2!vL7z"]
    assert found('password is "Xk9$ mQ2! vL7z pp" and so on') == ["Xk9$ mQ2! vL7z pp"]
    assert found("pwd: 'a,Kq7;Zp_4%w' x") == ["a,Kq7;Zp_4%w"]
    assert found('the secret is "see the manual, page three (below)" he said') == []
    assert found('pwd="unclosed Xk9$mQ2!vL7z') == [] and found('pwd="Xk9$mQ2!vL7zT unclosed') == ["Xk9$mQ2!vL7zT"]
    assert found("pwd=my_token=ABCDEFGH12") == []


def test_guess_cost_against_all_segmentations():
    """The dynamic program finds the cheapest of all segmentations."""
    import math
    import random

    rng = random.Random(8)
    for _ in range(200):
        s = "".join(rng.choice(["pass", "qwe", "19", "99", "a", "Z", "!", "x9", "abc", "summer"]) for _ in range(3))[:12]
        parts = {}
        for i, j, cost in secrets._parts(s):
            parts[i, j] = min(cost, parts.get((i, j), math.inf))
        each = math.log10(secrets._alphabet(s))

        def cheapest(i):
            if i == len(s):
                return 0.0
            return min([each + cheapest(i + 1), *[c + 0.3 + cheapest(j) for (a, j), c in parts.items() if a == i]])

        assert math.isclose(secrets.guess_cost(s), cheapest(0), abs_tol=1e-9)
