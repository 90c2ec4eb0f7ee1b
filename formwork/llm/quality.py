"""Quality rules with built-in functions only: counts of words, symbols, repeated lines
and repeated word windows, and the distance of a text from its language.

The method compares two histograms of a document with those of all documents of its
language by Jensen-Shannon distance (base 2): characters by class, and words by common
word. Short texts are not judged: their histograms say little.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formwork.llm.frames import quoted, without

#: Common words of the languages that are judged (fixed values).
COMMON_WORDS = {
    "de": "der die und in den von zu das sich mit auf für des ist im dem".split(),
    "en": "the of and to a in is that it for was on with as be by".split(),
    "es": "de la que el en y los se las del un por con no una para".split(),
    "fr": "de la le et les des en un du une que est pour par avec qui".split(),
}
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Limits:
    """A text is rejected by its character classes from ``class_words`` words on beyond
    ``class_distance``, by its common words from ``word_words`` on beyond
    ``word_distance``, and by both together from ``both_words`` on beyond the ``both``
    distances."""

    class_words: int = 50
    class_distance: float = 0.31
    word_words: int = 200
    word_distance: float = 0.23
    both_words: int = 100
    both_class_distance: float = 0.125
    both_word_distance: float = 0.26


LIMITS = Limits()
CLASSES = ("letter", "other_letter", "digit", "symbol", "space", "rest")


def _removed(text: Column, pattern: str) -> Column:
    """Length of what stays of a text without the matches of a pattern."""
    return F.length(F.regexp_replace(text, pattern, ""))


def _staged(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns({f"__q_{k}": v for k, v in columns.items()})


def _histograms(df: DataFrame) -> DataFrame:
    """Words (as hashes), character classes and common words of ``__q_text``."""
    df = _staged(df, words=F.filter(F.split("__q_text", SPACES), lambda w: w != ""))
    df = _staged(df, hashes=F.transform("__q_words", lambda w: F.xxhash64(w)), word_chars=F.length(F.array_join("__q_words", "")), n_words=F.size("__q_words").cast("long"))
    listed = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    wanted = None
    for lang, words in COMMON_WORDS.items():
        own = F.array(*[F.xxhash64(F.lit(w)) for w in words])
        wanted = F.when(F.col("__q_lang") == lang, own) if wanted is None else wanted.when(F.col("__q_lang") == lang, own)
    hash_of = [F.xxhash64(F.lit(w)) for w in listed]
    text = F.col("__q_text")
    df = _staged(
        df,
        common=F.filter("__q_hashes", lambda h: h.isin(*hash_of)),
        wanted=wanted,
        n_chars=F.length(text),
        n_symbols=_removed(text, r"[^#*$%&|<>]+").cast("long"),
        letters=_removed(text, r"[^A-Za-z]+"),
        digits=_removed(text, r"[^0-9]+"),
        others=_removed(text, r"[\x00-\x7F]+"),
    )
    df = _staged(df, bins=F.transform("__q_wanted", lambda k: F.size("__q_common") - F.size(F.array_remove(F.col("__q_common"), k))))
    classes = [F.col(f"__q_{c}") for c in ("letters", "others", "digits", "n_symbols")] + [F.col("__q_n_chars") - F.col("__q_word_chars")]
    rest = F.col("__q_n_chars") - sum(classes[1:], classes[0])
    return _staged(
        df,
        class_counts=F.array(*[c.cast("double") for c in [*classes, rest]]),
        word_counts=F.transform(F.concat("__q_bins", F.array((F.col("__q_n_words") - F.aggregate("__q_bins", F.lit(0), lambda a, x: a + x)).cast("int"))), lambda x: x.cast("double")),
    )


def _distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms (base 2)."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)

    def term(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)

    parts = F.zip_with(F.transform(counts, lambda x: x / total), reference, lambda p, q: 0.5 * term(p, (p + q) / 2) + 0.5 * term(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)))


def language_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[list[float], list[float]]]:
    """Character-class and common-word histograms (as shares) over all documents of each
    language of ``COMMON_WORDS``: one row per listed language reaches the driver."""
    df = docs.select(F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("__q_text"), F.col(quoted(lang_col)).cast("string").alias("__q_lang"))
    df = _histograms(df.where(F.col("__q_lang").isin(*COMMON_WORDS)))
    n_bins = max(map(len, COMMON_WORDS.values())) + 1
    sums = [F.sum(F.get("__q_class_counts", F.lit(i))).alias(f"c{i}") for i in range(len(CLASSES))] + [F.sum(F.get("__q_word_counts", F.lit(i))).alias(f"w{i}") for i in range(n_bins)]
    out = {}
    for r in df.groupBy("__q_lang").agg(*sums).collect():
        classes = [r[f"c{i}"] for i in range(len(CLASSES))]
        words = [r[f"w{i}"] for i in range(len(COMMON_WORDS[r["__q_lang"]]) + 1)]
        if sum(classes) and sum(words):
            out[r["__q_lang"]] = ([x / sum(classes) for x in classes], [x / sum(words) for x in words])
    return out


NEW = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]


def judge_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = LIMITS, references: dict[str, tuple[list[float], list[float]]] | None = None) -> DataFrame:
    """Add the counts, distances and verdict of every whole text.

    The columns of ``docs`` stay, clashing ones are replaced by ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (words in
    five-word windows found twice or more), ``class_distance`` and ``word_distance``
    (null where the language has no reference or the text is empty), ``base_failed``
    and ``kept``. Null and empty texts have no words and fail; texts of other or null
    languages are judged by the counts alone; repeated rows get equal results; no rows
    give no rows. References come from ``docs`` unless given.
    """
    if references is None:
        references = language_references(docs, text_col, lang_col)
    kept = without(docs, NEW)
    df = docs.select(*[F.col(quoted(c)) for c in kept], F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("__q_text"), F.col(quoted(lang_col)).cast("string").alias("__q_lang"))
    df = _histograms(df)
    h = F.col("__q_hashes")
    at = lambda i, k: F.get(h, i + k)
    windows = F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - 4, F.lit(0))), lambda x, i: F.xxhash64(x, at(i, 1), at(i, 2), at(i, 3), at(i, 4)))
    lines = F.transform(F.filter(F.split("__q_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.xxhash64(x))
    df = _staged(df, windows=windows, lines=lines)
    # the windows in order of their hash, only where one occurs twice
    again = F.size(F.array_distinct("__q_windows")) < F.size("__q_windows")
    df = _staged(df, pairs=F.when(again, F.sort_array(F.transform("__q_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))), n_dup_lines=(F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long"))
    pairs = F.col("__q_pairs")
    same = lambda j, k: F.coalesce(F.get(pairs, j)["h"] == F.get(pairs, k)["h"], F.lit(False))
    df = _staged(df, repeated=F.sort_array(F.transform(F.filter(pairs, lambda p, j: same(j, j + 1) | ((j > 0) & same(j, F.greatest(j - 1, F.lit(0))))), lambda p: p["i"])))
    r = F.col("__q_repeated")
    gaps = F.zip_with(F.slice(r, F.lit(2), F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(5)))
    covered = F.when(r.isNull(), F.lit(0)).otherwise(F.aggregate(gaps, F.lit(5), lambda a, x: a + x))
    df = _staged(df, n_repeat_words=covered.cast("long"))
    lang = F.col("__q_lang")
    reference: list[Column] = [F.lit(None).cast("array<double>")] * 2
    for name, both in references.items():
        reference = [F.when(lang == name, F.array(*[F.lit(x) for x in own])).otherwise(rest) for own, rest in zip(both, reference)]
    n = F.col("__q_n_words")
    judged = n > 0
    df = _staged(df, class_reference=reference[0], word_reference=reference[1])
    df = _staged(
        df,
        class_distance=F.when(judged, _distance(F.col("__q_class_counts"), F.col("__q_class_reference"))),
        word_distance=F.when(judged, _distance(F.col("__q_word_counts"), F.col("__q_word_reference"))),
        base_failed=(n < 10) | (100 * F.col("__q_n_repeat_words") > 20 * n),
    )
    c, w = F.col("__q_class_distance"), F.col("__q_word_distance")
    odd = (
        ((n >= limits.class_words) & (c > limits.class_distance))
        | ((n >= limits.word_words) & (w > limits.word_distance))
        | ((n >= limits.both_words) & (c > limits.both_class_distance) & (w > limits.both_word_distance))
    )
    df = _staged(df, kept=~F.col("__q_base_failed") & ~F.coalesce(odd, F.lit(False)))
    # one generated row each: a filter on a verdict stays above the expressions, which
    # would otherwise be put into it once for every use
    judged_row = F.struct(*[(F.col(f"__q_{x}").cast("long") if x == "word_chars" else F.col(f"__q_{x}")).alias(x) for x in NEW])
    return df.select(*[F.col(quoted(x)) for x in kept], F.inline(F.array(judged_row)))
