"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds
spans the patterns miss.

The field scores whole candidate segments (digits in all, separators, check digits,
neighbours), and a dynamic program over segments of at most ``MAX_TOKENS`` tokens picks
boundaries and types of a passage jointly. It is trained here, by its likelihood, on a
bounded sample of passages of the documents themselves: the spans of the patterns are
the labels; half of the passages are rewritten by ``VARIANTS`` (spelt-out or broken-up
forms), some are spoilt to near misses that are labelled as plain text.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formwork.llm.frames import map_text, quoted

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 14
#: Labelled passages the field is fitted on, at most.
TRAINING_ROWS = 240
EPOCHS = 6
#: Log-odds by which a segmentation with one more span must be better.
MARGIN = 2.0

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_MARK = re.compile(r"[0-9@]")
#: The "at" of an address without an at-sign: in brackets, or between blanks where a
#: spelt-out dot follows (the forms of ``_ADDRESS``).
_SPELT_AT = re.compile(r"(?<=[(\[])at(?=[)\]])|(?<= )at(?= [a-z0-9-]+(?: dot [a-z0-9-]+)* dot [a-z]{2})", re.IGNORECASE | re.ASCII)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str):
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _addresses(text: str):
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in parts[k : k + 4]):
                yield at, end
            at = end + 1


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind, then start (code points, end exclusive)."""
    if not _MARK.search(text):
        return []
    out = [("email", a, b) for a, b in _emails(text)]
    out += [("ip", a, b) for a, b in _addresses(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
            out.append(("phone", *m.span()))
    return out


_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_|\w")


@dataclass
class Passage:
    """Tokens of a stretch of text around digits, at-signs and spelt-out ones."""

    text: str
    spans: list[tuple[int, int]]  # of tokens, in the text

    def tokens(self) -> list[str]:
        return [self.text[a:b] for a, b in self.spans]


def passages(text: str):
    """Stretches that can hold a span: tokens within MAX_TOKENS of a marked one."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    spelt = {m.start() for m in _SPELT_AT.finditer(text)}
    first = last = -1
    for i, (a, b) in enumerate(spans):
        if _MARK.match(text, a, b) or a in spelt:
            if first >= 0 and i - MAX_TOKENS > last:
                yield Passage(text, spans[first:last])
                first = -1
            if first < 0:
                first = max(i - MAX_TOKENS, last, 0)
            last = min(i + MAX_TOKENS, len(spans))
    if first >= 0:
        yield Passage(text, spans[first:last])


_AT = frozenset(("@", "at", "AT", "At", "aT"))
#: What an address can look like: an at-sign or a bracketed "at", or a spelt-out one when
#: its dots are spelt out too; the last part has letters only.
_ADDRESS = re.compile(
    r"[A-Za-z0-9._%+-]+(?: dot [A-Za-z0-9_%+-]+)*"
    r"(?: ?(?:@|[(\[]at[)\]]) ?[A-Za-z0-9-]+(?:(?:\.| dot )[A-Za-z0-9-]+)*(?:\.| dot )| at [A-Za-z0-9-]+(?: dot [A-Za-z0-9-]+)* dot )[A-Za-z]{2,}",
    re.IGNORECASE | re.ASCII,
)


def candidates(p: Passage):
    """Segments (first token, last token + 1, kind) that can be a span of the kind."""
    tokens = p.tokens()
    n = len(tokens)
    for i in range(n):
        head = tokens[i]
        word, digit = head[0].isalpha(), "0" <= head[0] <= "9"
        if not (word or digit or head in "+(["):
            continue
        digits = numbers = at = words = 0
        for j in range(i, min(n, i + MAX_TOKENS)):
            t = tokens[j]
            if j > i and p.spans[j][0] - p.spans[j - 1][1] > 1:
                break  # a gap of more than one blank
            if "0" <= t[0] <= "9":
                digits += len(t)
                numbers += 1
            elif t in _AT:
                at += 1
            elif t[0].isalpha():
                words += 1
            if digits > 24 or words > 8:
                break
            tail = t[0].isalpha() or "0" <= t[0] <= "9"
            if not tail:
                continue
            if at == 1 and words and j - i >= 4 and head not in "+([" and _ADDRESS.fullmatch(p.text, p.spans[i][0], p.spans[j][1]):
                yield i, j + 1, "email"
            if not words and not at:
                if numbers == 4 and digits <= 12 and digit and j > i + 2:
                    yield i, j + 1, "ip"
                if 13 <= digits <= 19 and digit:
                    yield i, j + 1, "card"
                if 9 <= digits <= 15:
                    yield i, j + 1, "phone"


def features(p: Passage, i: int, j: int, kind: str) -> list[str]:
    """Names of the features of one whole segment."""
    a, b = p.spans[i][0], p.spans[j - 1][1]
    s = p.text[a:b]
    groups = _DIGITS.findall(s)
    digits = "".join(groups)
    between = "".join(sorted(set(re.sub(r"[\w]+", "", s))))
    before = p.text[a - 1] if a else "^"
    after = p.text[b] if b < len(p.text) else "$"
    edge = lambda c: "w" if c.isalnum() else "s" if c.isspace() else c if c in "^$.,;:+-@_" else "p"
    out = [kind, f"{kind} between {between}", f"{kind} before {edge(before)}", f"{kind} after {edge(after)}", f"{kind} head {edge(s[0])}"]
    if kind == "email":
        words = re.findall(r"[^\W_]+", s)
        out += [f"email at {'@' in s}", f"email dots {min(s.count('.') + sum(w.lower() == 'dot' for w in words), 4)}", f"email blanks {min(s.count(' '), 4)}", f"email last {min(len(words[-1]), 5)}", f"email at-sides {sum(w.lower() == 'at' for w in words)}"]
    elif kind == "ip":
        out += [f"ip bytes {all(len(g) <= 3 and int(g) <= 255 for g in groups)}", f"ip one separator {len({x for x in re.sub(r'[0-9]', ' ', s).split()})}", f"ip runs {len(set(re.findall(r'[^0-9]+', s)))}"]
    else:
        out += [f"{kind} digits {len(digits)}", f"{kind} groups {min(len(groups), 6)}", f"{kind} longest {min(max(map(len, groups)), 9)}", f"{kind} shape {'-'.join(str(len(g)) for g in groups[:6])}"]
        if kind == "card":
            out.append(f"card check {luhn(digits)}")
    return out


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


@dataclass
class SemiMarkov:
    """Weights by feature name; a plain token is a segment of its own and scores 0."""

    weights: dict[str, float] = field(default_factory=dict)

    def score(self, names: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in names)

    def best(self, p: Passage, margin: float = MARGIN) -> list[tuple[str, int, int]]:
        """Spans of the best segmentation of a passage (boundaries and types at once)."""
        n = len(p.spans)
        arcs: list[list[tuple[int, str, float]]] = [[] for _ in range(n + 1)]
        for i, j, kind in candidates(p):
            if (v := self.score(features(p, i, j, kind)) - margin) > 0:
                arcs[j].append((i, kind, v))
        total: list[float] = [0.0] * (n + 1)
        back: list[tuple[int, str] | None] = [None] * (n + 1)
        for j in range(1, n + 1):
            total[j] = total[j - 1]
            for i, kind, v in arcs[j]:
                if total[i] + v > total[j]:
                    total[j], back[j] = total[i] + v, (i, kind)
        out, j = [], n
        while j:
            if back[j]:
                i, kind = back[j]
                out.append((kind, p.spans[i][0], p.spans[j - 1][1]))
                j = i
            else:
                j -= 1
        return out[::-1]

    def fit(self, data: list[tuple[Passage, list[tuple[str, int, int]]]], epochs: int = EPOCHS) -> SemiMarkov:
        """Raise the likelihood of the labelled segmentations by adaptive gradient steps."""
        prepared = []
        for p, gold in data:
            wanted = {(a, b, k) for k, a, b in gold}
            arcs = [(i, j, features(p, i, j, k), (p.spans[i][0], p.spans[j - 1][1], k) in wanted) for i, j, k in candidates(p)]
            prepared.append((len(p.spans), arcs))
        squares: dict[str, float] = {}
        for _ in range(epochs):
            for n, arcs in prepared:
                for f, g in self._gradient(n, arcs).items():
                    g -= 1e-3 * self.weights.get(f, 0.0)
                    squares[f] = squares.get(f, 1e-8) + g * g
                    self.weights[f] = self.weights.get(f, 0.0) + 0.5 * g / math.sqrt(squares[f])
        return self

    def _gradient(self, n: int, arcs) -> dict[str, float]:
        """Observed less expected feature counts (forward and backward sums)."""
        scored = [(i, j, self.score(names)) for i, j, names, _ in arcs]
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j, _) in enumerate(scored):
            ending[j].append(k)
            starting[i].append(k)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1], *[ahead[scored[k][0]] + scored[k][2] for k in ending[j]]])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *[behind[scored[k][1]] + scored[k][2] for k in starting[i]]])
        out: dict[str, float] = {}
        for (i, j, v), (_, _, names, gold) in zip(scored, arcs):
            change = gold - math.exp(ahead[i] + v + behind[j] - ahead[n])
            if abs(change) > 1e-6:
                for f in names:
                    out[f] = out.get(f, 0.0) + change
        return out


#: How labelled spans are rewritten for training: forms the patterns do not match.
VARIANTS = {
    "email": (lambda s: s.replace("@", " at ").replace(".", " dot "), lambda s: s.replace("@", " [at] "), lambda s: s.replace("@", "(at)"), lambda s: s.replace("@", " @ ")),
    "ip": (lambda s: s.replace(".", "[.]"), lambda s: s.replace(".", " . "), lambda s: s.replace(".", "(.)")),
    "card": (lambda s: ".".join(re.findall(r"[0-9]{1,4}", s)), lambda s: "_".join(re.findall(r"[0-9]{1,4}", s)), lambda s: "/".join(re.findall(r"[0-9]{1,4}", s))),
    "phone": (lambda s: "(" + s.split("(", 1)[1] if "(" in s else s, lambda s: s.replace("+", "00"), lambda s: s.lstrip("+").replace("(", "").replace(")", "").replace(" ", "-")),
}


def _spoilt(kind: str, s: str, rng: random.Random) -> str:
    """A near miss of a span: wrong check digit, number too large, too few digits."""
    if kind == "card":
        return s[:-1] + str((int(s[-1]) + rng.randint(1, 9)) % 10)
    if kind == "ip":
        return ".".join([str(rng.randint(256, 999)), *s.split(".")[1:]])
    if kind == "phone":
        return "".join(c for c in s if c.isdigit())[:6]
    return s.split("@")[0]


def training_data(texts: list[str], limit: int = TRAINING_ROWS) -> list[tuple[Passage, list[tuple[str, int, int]]]]:
    """Labelled passages from texts, some rewritten, at most ``limit``."""
    rng = random.Random(17)
    out = []
    for text in texts:
        for kind, a, b in pattern_spans(text):
            left, right = text[max(0, a - 60) : a], text[b : b + 60]
            if pattern_spans(left) or pattern_spans(right):
                continue
            draw, body = rng.random(), text[a:b]
            gold = True
            if draw < 0.5:
                body = rng.choice(VARIANTS[kind])(body)
            elif draw < 0.75:
                body, gold = _spoilt(kind, body, rng), False
            made = left + body + right
            labels = [(kind, len(left), len(left) + len(body))] if gold else []
            out += [(p, labels) for p in passages(made)]
            if len(out) >= limit:
                return out[:limit]
    return out


def fit_model(docs: DataFrame, text_col: str = "text", rows: int = TRAINING_ROWS) -> SemiMarkov:
    """A field fitted on at most ``rows`` passages of the marked texts with the least
    hash (whole texts of up to 20,000 characters); none marked: it adds nothing."""
    text = F.col(quoted(text_col)).cast("string")
    # an at-sign or a long run of digits and their separators: where the patterns can match
    marked = text.rlike(r"[A-Za-z0-9]@[A-Za-z0-9]|[0-9][0-9 ().-]{7,}[0-9]") & (F.length(text) <= 20_000)
    hashed = docs.where(marked).select(text.alias("t"), F.xxhash64(text).alias("h"))
    # only hashes are ranked on the driver; then the texts up to the last of them are read
    last = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(rows).collect()]
    sample = hashed.where(F.col("h") <= last[-1]).groupBy("h").agg(F.first("t").alias("t")).orderBy("h").collect() if last else []
    return SemiMarkov().fit(training_data([r["t"] for r in sample], rows))


SPAN = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()),
])


def all_spans(text: str, model: SemiMarkov) -> list[tuple[str, int, int, bool]]:
    """Pattern spans and the field's spans that overlap none of them, by kind, start."""
    if not _MARK.search(text) and not _SPELT_AT.search(text):
        return []
    base = pattern_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    out = [(*s, True) for s in base]
    if model.weights:
        starts, k = taken, 0
        for p in passages(text):
            for kind, a, b in model.best(p):
                while k < len(starts) and starts[k][1] <= a:
                    k += 1
                if all(x >= b or y <= a for x, y in starts[k : k + 8]):
                    out.append((kind, a, b, False))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def mask(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        out += [text[at : max(a, at)], f"[{kind}]"] if a >= at else []
        at = b
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, text_col: str = "text", model: SemiMarkov | None = None) -> DataFrame:
    """Personal data in every whole text, fitted on ``docs`` unless a model is given.

    Adds ``spans`` (kind, start, end in code points, base: found by a pattern), sorted
    by kind as listed and start, and ``masked_text``; clashing names are replaced. Null
    and empty texts have no spans (and an empty masked text); repeated rows give
    repeated results; no rows give no rows.
    """
    field_ = model if model is not None else fit_model(docs, text_col)
    new = T.StructType([T.StructField("spans", T.ArrayType(SPAN)), T.StructField("masked_text", T.StringType())])

    def make():
        def run(texts: list[str]):
            for t in texts:
                spans = all_spans(t, field_)
                yield [dict(zip(SPAN.names, s)) for s in spans], mask(t, spans) if spans else t

        return run

    return map_text(docs, text_col, new, make)


def span_digest(spans: Column) -> Column:
    """``kind:start:end`` of the spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def n_base(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
