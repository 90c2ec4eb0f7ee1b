"""Brute-force versions the operators are held against."""

from __future__ import annotations

import collections
import math
import re

from formwork.llm.quality import COMMON_WORDS, LIMITS

LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))

#: Rows every operator over texts must take: nulls, empty and blank texts, a very long
#: one, repeated rows, no id; with columns whose names clash with results.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "a few plain words only"), (5, "a few plain words only"),
    (6, LONG + " with one more tail"), (7, "x " * 200), (8, "été \U0001f600 \x00 \x85   z"), (None, "a row without an id"),
]
CLASHES = ("n_words", "kept", "spans", "notices", "ids", "decoded", "removed", "kept_text", "piece", "offset", "sequence_id", "masked_text", "row", "d", "key", "bucket", "label")


def edge_frame(spark, rows=EDGE):
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en" if n % 2 else None, *["own"] * len(CLASHES)) for n, (i, t) in enumerate(rows)], schema)


def removed_words(texts, window=35):
    """(kept words, number removed) of every text."""
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[a : a + window]) for w in words for a in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a : a + window])] > 1:
                gone.update(range(a, a + window))
        out.append(([x for i, x in enumerate(w) if i not in gone], len(gone)))
    return out


def similarity(a, b):
    """Probability Jaccard similarity of two counters."""
    both = a.keys() & b.keys()
    total = {}
    for r in {a[x] / b[x] for x in both}:
        total[r] = sum(max(a[x], r * b[x]) for x in a.keys() | b.keys())
    return sum(a[x] / total[a[x] / b[x]] for x in both)


def shingles(text, size=5):
    """Runs of ``size`` words and their counts; fewer words are one run."""
    w = text.encode().split()
    return collections.Counter(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1)))


def classes(rows, least=0.8):
    """Smallest id of the class of every (id, text), by comparing all texts."""
    texts = {}
    for i, t in rows:
        if (t or "").encode().split():
            texts.setdefault(t, []).append(i)
    keys = list(texts)
    sets = [shingles(t) for t in keys]
    root = list(range(len(keys)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(keys)):
        for b in range(a):
            if similarity(sets[a], sets[b]) >= least:
                root[find(a)] = find(b)
    low = {}
    for a, t in enumerate(keys):
        for i in texts[t]:
            r = find(a)
            low[r] = i if low.get(r) is None else low[r] if i is None else min(low[r], i)
    where = {t: a for a, t in enumerate(keys)}
    return [low[find(where[t])] if t in where else i for i, t in rows]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def personal(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    check = lambda d: sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(t) if 13 <= len(digits(m.group())) <= 19 and check(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m.group())) <= 15]


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def secret(t):
    out = [("assign", *m.span()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 16]
    return out + [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 32]


def _features(t, lang):
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    bins = [words.count(w) for w in COMMON_WORDS[lang]] if lang in COMMON_WORDS else None
    letters, digits, symbols, others = (len(re.findall(p, t)) for p in ("[A-Za-z]", "[0-9]", r"[#*$%&|<>]", r"[^\x00-\x7F]"))
    spaces = len(re.findall(r"[\x20\x09-\x0D]", t))
    return words, [letters, others, digits, symbols, spaces, len(t) - letters - others - digits - symbols - spaces], bins and [*bins, len(words) - sum(bins)]


def _distance(p, q):
    sp, sq, total = sum(p), sum(q), 0.0
    for a, b in zip(p, q):
        a, b = a / sp, b / sq
        for x in (a, b):
            total += 0.5 * x * math.log2(2 * x / (a + b)) if x else 0
    return math.sqrt(max(total, 0))


def quality(rows):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)
    of every (text, lang)."""
    made = [(*_features(t or "", lang), t or "", lang) for t, lang in rows]
    reference = {}
    for _, c, b, _, lang in made:
        if b:
            old = reference.get(lang, ([0] * len(c), [0] * len(b)))
            reference[lang] = ([x + y for x, y in zip(old[0], c)], [x + y for x, y in zip(old[1], b)])
    out = []
    for words, c, b, t, lang in made:
        n = len(words)
        grams = collections.Counter(tuple(words[a : a + 5]) for a in range(n - 4))
        again = {a + k for a in range(n - 4) if grams[tuple(words[a : a + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = n < 10 or 100 * len(again) > 20 * n
        odd = False
        if b and n and sum(reference[lang][1]):
            dc, dw = _distance(c, reference[lang][0]), _distance(b, reference[lang][1])
            m = LIMITS
            odd = n >= m.class_words and dc > m.class_distance or n >= m.word_words and dw > m.word_distance or n >= m.both_words and dc > m.both_class_distance and dw > m.both_word_distance
        out.append((n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed, not failed and not odd))
    return out
