"""Secrets: fixed patterns, and guess costs of values in credential contexts.

The guess cost of a value is the least number of guesses (log10) over all its
segmentations into common words and affixes, dates, repeats, keyboard walks, runs of consecutive
characters and brute-force spans, found by dynamic programming. A value in a credential
context whose cost reaches a threshold is a secret.
"""

from __future__ import annotations

import json
import math
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from formwork.llm.frames import map_text
from formwork.llm.tokens import vocabulary_path

KINDS = ("assign", "access", "hex", "guess")
#: log10 of the guesses from which a value in a credential context is a secret.
MIN_GUESSES = 8.0
MAX_PART = 40

_ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Credential contexts of the method: a name, a sign or "is", then the value, which ends
#: with its quote, or without quotes at a blank, comma or semicolon.
_CONTEXT = re.compile(
    r"""(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code|wort)?|pwd|pin|secret|token|api[ _-]?key|access[ _-]?key|client[ _-]?secret|private[ _-]?key|auth(?:orization)?|bearer|credentials?)"""
    r"""["']?[\x20\t]*(?:=>|:=|[:=]|\bis\b|\bbearer\b)[\x20\t]*(?:"(?P<double>[^"\r\n]+)"|'(?P<single>[^'\r\n]+)'|["']?(?:bearer[\x20\t]+)?(?P<plain>[^\s"'<>,;]+))""",
    re.IGNORECASE | re.ASCII,
)
_CONTEXT_HINT = re.compile(r"pass|pwd|pin|secret|token|key|auth|bearer|credential", re.IGNORECASE | re.ASCII)

#: Common parts of guessable values, most common first.
COMMON = (
    "password 123456 12345678 qwerty abc123 letmein admin welcome monkey dragon master login hello freedom "
    "whatever trustno1 iloveyou sunshine princess football baseball shadow superman michael ninja mustang "
    "secret changeme default root user test guest demo example temp pass token key access system server "
    "love summer winter spring autumn january december company office home money computer internet "
    "the and for you with this that from have your not are was but all can her one our out day get"
).split()
#: Endings and beginnings of words, and log10 of their number.
AFFIXES = frozenset("s es ed er ers or ors ing ings ly al ally ion ions ment ments ness able ible ity ies ful less ish ism ist ists ized ised izing un re dis non pre sub over".split())
AFFIX_COST = math.log10(len(AFFIXES))
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik,9ol.0p;/")
_NEXT = {(a, b) for row in ROWS for a, b in zip(row, row[1:])} | {(b, a) for row in ROWS for a, b in zip(row, row[1:])}
_PLAIN = str.maketrans("0134578@$!", "oieastbasi")
#: Marks around words of prose, and what may stand between a value and a span after it.
_MARKS = ".,:;!?()[]-\u2026"
_BETWEEN = "&|/;,?#:+"
_DATE = re.compile(r"(?:(?:19|20)[0-9]{2}(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12][0-9]|3[01]))?)?|(?:0?[1-9]|[12][0-9]|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:(?:19|20)?[0-9]{2}))")


@lru_cache(maxsize=1)
def ranks() -> tuple[dict[str, int], frozenset[str], int]:
    """Rank of every guessable word (``COMMON``, then the words of the public vocabulary,
    which lists them by how often they are merged), their beginnings, and the greatest
    length."""
    with open(vocabulary_path(), encoding="utf-8") as f:
        listed = json.load(f)["model"]["vocab"]
    out = {w: i + 1 for i, w in enumerate(COMMON)}
    for t in sorted(listed, key=listed.get):
        # whole words begin with the letter that stands for a blank
        if t[0] == "\u0120" and len(t) > 3 and t[1:].isascii() and t[1:].isalpha():
            out.setdefault(t[1:].lower(), len(out) + 1)
    return out, frozenset(w[:3] for w in out), max(map(len, out))


def _alphabet(s: str) -> int:
    return max(10, 26 * any("a" <= c <= "z" for c in s) + 26 * any("A" <= c <= "Z" for c in s) + 10 * any("0" <= c <= "9" for c in s) + 33 * any(not c.isalnum() for c in s) + 100 * any(ord(c) > 127 for c in s))


def _parts(s: str):
    """Segments (start, end, log10 of guesses) of the cheap kinds."""
    n, low = len(s), s.lower()
    plain = low.translate(_PLAIN)
    rank, heads, longest = ranks()
    for i in range(n):
        for j in range(i + 1, min(n, i + 5) + 1):
            if low[i:j] in AFFIXES:
                yield i, j, AFFIX_COST + (0.0 if s[i:j].islower() else 0.1 * (j - i))
        for j in range(i + 3, min(n, i + longest) + 1) if low[i : i + 3] in heads or plain[i : i + 3] in heads else ():
            for word, extra in ((low[i:j], 0.0), (plain[i:j], 0.3)):
                if (r := rank.get(word)) is not None:
                    case = 0.0 if s[i:j].islower() or not s[i:j].isalpha() else 0.3 if s[i].isupper() and s[i + 1 : j].islower() else 0.1 * (j - i)
                    yield i, j, math.log10(r * 2) + extra + case
        for j in range(min(n, i + 10), i + 3, -1):
            if _DATE.fullmatch(s, i, j):
                yield i, j, math.log10(365 * 120) if j - i > 4 else math.log10(120)
    i = 0
    while i < n - 1:  # keyboard walks
        j = i + 1
        while j < n and (low[j - 1], low[j]) in _NEXT:
            j += 1
        if j - i >= 3:
            yield i, j, math.log10(47 * 8 * (j - i))
        i = max(i + 1, j - 1)
    i = 0
    while i < n - 1:  # consecutive characters
        step = ord(s[i + 1]) - ord(s[i])
        j = i + 2
        while j < n and ord(s[j]) - ord(s[j - 1]) == step:
            j += 1
        if j - i >= 3 and step in (-1, 1):
            yield i, j, math.log10(26 * 2 * (j - i))
        i = max(i + 1, j - 1)
    for unit in range(1, min(16, n // 2) + 1):  # repeats of a unit
        i = 0
        while i + 2 * unit <= n:
            j = i + unit
            while j < n and s[j] == s[j - unit]:
                j += 1
            times = (j - i) // unit
            if times >= 2 and unit * times >= 3:
                yield i, i + unit * times, unit * math.log10(_alphabet(s[i : i + unit])) + math.log10(times)
                i += unit * times
            else:
                i = max(i + 1, j - unit)


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation of a whole value takes."""
    s = value
    each = math.log10(_alphabet(s))
    ends: list[list[tuple[int, float]]] = [[] for _ in range(len(s) + 1)]
    for i, j, cost in _parts(s):
        ends[j].append((i, cost))
    best = [0.0] + [math.inf] * len(s)
    for j in range(1, len(s) + 1):
        best[j] = min([best[j - 1] + each, *[best[i] + cost + 0.3 for i, cost in ends[j]]])
    return best[-1]


def value_cost(value: str) -> float:
    """The guess cost of a value; of one with blanks, the sum over its pieces that are no
    plain words, so that quoted prose costs nothing."""
    pieces = value.split()
    if len(pieces) < 2:
        return guess_cost(value)
    return sum(guess_cost(p) for p in pieces if not p.strip(_MARKS).isalpha() and p.strip(_MARKS))


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns (code points, end exclusive)."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", *m.span()) for m in _HEX.finditer(text)]


def all_spans(text: str, least: float = MIN_GUESSES) -> list[tuple[str, int, int, bool, float | None]]:
    """Pattern spans (assignments with the cost of their value) and costly values in
    credential contexts that overlap none of them, by start, then kind as listed."""
    base = pattern_spans(text)
    out = []
    for kind, a, b in base:
        cost = guess_cost(_ASSIGN.match(text, a).group(2)) if kind == "assign" else None
        out.append((kind, a, b, True, cost))
    if _CONTEXT_HINT.search(text):
        taken = sorted((a, b) for _, a, b in base)
        k = at = 0
        while m := _CONTEXT.search(text, at):
            a, at = m.span(m.lastgroup)
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            value = text[a:at]
            if k < len(taken) and taken[k][0] < at:
                # up to a base span, and on after the span
                x, at = taken[k]
                value = text[a:x].rstrip().rstrip(_BETWEEN) if x > a else ""
            value = value.rstrip(".:!?)") if m.lastgroup == "plain" else value.rstrip()
            if (cost := value_cost(value)) >= least:
                out.append(("guess", a, a + len(value), False, cost))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


SPAN = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()),
    T.StructField("log10_guesses", T.DoubleType()),
])


def find_secrets(docs: DataFrame, text_col: str = "text", min_guesses: float = MIN_GUESSES) -> DataFrame:
    """Secrets in every whole text: adds ``spans`` (kind, start, end in code points,
    base: found by a pattern, log10_guesses of assigned values), sorted by start and
    kind. A clashing name is replaced. Null and empty texts have no spans; repeated
    rows give repeated results; no rows give no rows."""

    def make():
        def run(texts: list[str]):
            for t in texts:
                yield ([dict(zip(SPAN.names, s)) for s in all_spans(t, min_guesses)],)

        return run

    return map_text(docs, text_col, T.StructType([T.StructField("spans", T.ArrayType(SPAN))]), make)
