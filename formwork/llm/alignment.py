"""Alignment of two tokenizers over a corpus of texts.

Texts are shuffled whole and equal ones meet: each distinct text is tokenised and aligned
once, and its links count as often as the text occurs. Distinct texts are taken in blocks
of bounded size; a block is one stretch of bytes, cut by both tokenizers, so tokens that
overlap and the places where both end are found for all its texts at once.

A block keeps the pairs of ids it links, with their weighted counts, and per text which
of them occur how often, in compressed arrays. Counts of pairs are summed over the blocks;
each block then fetches the counts of its own pairs once, by a join, and derives the
measures of its texts. Measures reach the documents by the digest of the text. A text of
very many documents would send them all to one task: its measures are laid out in
several copies, and its documents choose among these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from formwork.llm.frames import quoted, stored, without
from formwork.llm.tokens import SPLIT, PieceEncoder, Vocabulary, vocabulary_path

FIRST = "byte_bpe_50k.json"
SECOND = "piece_bpe_32k.model"
#: Characters of a block; a longer text is a block of its own.
BLOCK_CHARS = 3_000_000
#: Recent pieces of text that the first tokenizer remembers: memory only.
CACHED_PIECES = 150_000
#: A text of more documents than HOT_LEAST and one in HOT_PART of all is hot: there are
#: fewer than HOT_PART such texts, whatever the input.
HOT_PART = 1000
HOT_LEAST = 1000
_PAIR = 1 << 32


class Tokenizer:
    """Ids, token lengths and token bytes of one tokenizer; ``encode`` takes texts."""

    def __init__(self, token_bytes: list[bytes]) -> None:
        self.token_bytes = token_bytes
        self.length = np.array([len(t) for t in token_bytes], np.int64)


class ByteLevel(Tokenizer):
    """A byte-level vocabulary, encoding a space and the text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        v = Vocabulary(path)
        super().__init__([v.labels.get(i, b"") for i in range(max(v.labels) + 1)])
        bpe = tiktoken.Encoding("vocabulary", pat_str=SPLIT.pattern, mergeable_ranks=v.ids, special_tokens={})
        self._piece = PieceEncoder(lambda t: np.array(bpe.encode_ordinary(t), "<u4").tobytes(), {}, CACHED_PIECES)  # special tokens are plain text
        self._mark = self._piece.encode("x")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        # a letter in front makes the added space one between words; its token is cut off
        return [np.frombuffer(self._piece("x " + t), "<u4", offset=len(self._mark)).astype(np.int64) for t in texts]


class Pieces(Tokenizer):
    """A piece vocabulary that adds the space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        super().__init__([bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, loaded once per Python worker."""
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


def _spells(token_bytes: list[bytes], ids: list[int], raw: bytes) -> bool:
    return b"".join([token_bytes[i] for i in ids]) == raw


class Aligner:
    def __init__(self, first: Tokenizer, second: Tokenizer) -> None:
        self.a, self.b = first, second
        # an id followed by a comma, or by the mark that ends its side of a group
        self.text = np.array([f"{i}{mark}" for size, end in ((len(first.length), "|"), (len(second.length), ";")) for i in range(size) for mark in (",", end)], object)

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of texts by both tokenizers; none where either fails to spell a text."""
        none = np.zeros(0, np.int64)
        out = []
        for t, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts)):
            raw = (" " + t).encode("utf-8", "surrogatepass")
            fits = t and _spells(self.a.token_bytes, a.tolist(), raw) and _spells(self.b.token_bytes, b.tolist(), raw)
            out.append((a, b) if fits else (none, none))
        return out

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, n_links, groups text), and the links of the
        block as arrays: number of the text, first id, second id."""
        ids = self.tokens(texts)
        n_a, n_b = (np.array([len(x[s]) for x in ids], np.int64) for s in (0, 1))
        a, b = (np.concatenate([x[s] for x in ids]) for s in (0, 1))
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        of_a = np.repeat(np.arange(len(texts)), n_a)
        closes_a = np.zeros(len(a), bool)
        closes_b = np.zeros(len(b), bool)
        if len(a):
            at = np.searchsorted(end_b, end_a)
            closes_a = end_b[np.minimum(at, len(b) - 1)] == end_a
            closes_b[at[closes_a]] = True
        n_groups = np.bincount(of_a[closes_a], minlength=len(texts))
        # links: tokens of the second side from the one that covers the first byte of a
        # token of the first side to the one that covers its last byte
        low = np.searchsorted(end_b, end_a - self.a.length[a], "right")
        high = np.searchsorted(end_b, end_a, "left")
        count = high - low + 1
        first = np.repeat(np.arange(len(a)), count)
        second = np.arange(len(first)) + np.repeat(low - (np.cumsum(count) - count), count)
        n_links = np.bincount(of_a[first], minlength=len(texts))
        # texts of the groups: the first side of each group, then its second side
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        groups = int(closes_a.sum())
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + before_b[group_a]] = 2 * a + closes_a
        code[np.arange(len(b)) + (upto_a[group_b] if groups else 0)] = 2 * (len(self.a.length) + b) + closes_b
        cut = np.concatenate([[0], np.cumsum(n_a + n_b)])
        measures = []
        for i in range(len(texts)):
            spelt = "".join(self.text[code[cut[i] : cut[i + 1]]].tolist())[:-1]
            measures.append((int(n_a[i]), int(n_b[i]), int(n_groups[i]), int(n_links[i]), spelt))
        return measures, of_a[first], a[first], b[second]


_TEXT = T.StructType([
    T.StructField("digest", T.BinaryType()),
    *[T.StructField(n, T.LongType()) for n in ("copies", "n_a", "n_b", "n_groups", "n_links")],
    T.StructField("groups_sha256", T.StringType()),
])
_BLOCK = T.StructType([
    T.StructField("block", T.BinaryType()),
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("weights", T.ArrayType(T.LongType())),
    T.StructField("texts", T.ArrayType(_TEXT)),
    T.StructField("cut", T.BinaryType()),
    T.StructField("steps", T.BinaryType()),
    T.StructField("times", T.BinaryType()),
])


def _packed(x: np.ndarray) -> bytes:
    """Compressed little-endian numbers, in as few bytes each as the largest needs."""
    size = 1 if (top := int(x.max(initial=0))) < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(x.astype(f"<u{size}").tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), f"<u{raw[0]}").astype(np.int64)


def _block(aligner: Aligner, texts: list[str], digests: list[bytes], copies: list[int]) -> tuple:
    measures, text, a, b = aligner.align(texts)
    pair = a * _PAIR + b
    pairs, at = np.unique(pair, return_inverse=True)
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, at, np.array(copies, np.int64)[text])
    entry, times = np.unique(text * max(1, len(pairs)) + at, return_counts=True)
    own, place = np.divmod(entry, max(1, len(pairs)))
    cut = np.bincount(own, minlength=len(texts))
    steps = np.diff(place, prepend=0)
    first = np.cumsum(cut) - cut
    steps[first[cut > 0]] = place[first[cut > 0]]  # a text's places start anew
    rows = [{"digest": d, "copies": c, "n_a": m[0], "n_b": m[1], "n_groups": m[2], "n_links": m[3], "groups_sha256": hashlib.sha256(m[4].encode()).hexdigest() if m[4] else ""} for d, c, m in zip(digests, copies, measures)]
    return digests[0], pairs, weights, rows, _packed(cut), _packed(steps), _packed(times)


def _blocks(first: str | None, second: str | None, chars: int):
    arrow = to_arrow_schema(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(tokenizer(first or vocabulary_path(FIRST)), tokenizer(second or vocabulary_path(SECOND)))

        def made(held: list[tuple]) -> pa.RecordBatch:
            row = _block(aligner, *map(list, zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and size + len(row[0]) > chars:
                    yield made(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[0])
        if held:
            yield made(held)

    return run


_MEASURES = "digest binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _judged(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Measures of the texts of a block from the counts of its pairs."""
    block = blocks.iloc[0]
    pairs = np.asarray(block["pairs"], np.int64)
    order = np.argsort(known := counts["pair"].to_numpy(), kind="stable")
    at = order[np.searchsorted(known, pairs, sorter=order)] if len(pairs) else order
    count, best = counts["count"].to_numpy()[at], counts["best"].to_numpy()[at]
    cut, steps, times = (_unpacked(block[c]) for c in ("cut", "steps", "times"))
    own = np.repeat(np.arange(len(cut)), cut)
    total = np.cumsum(steps.astype(np.int64))
    first = np.cumsum(cut) - cut
    some = cut > 0
    base = np.zeros(len(cut), np.int64)
    base[some] = total[first[some]] - steps[first[some]]
    place = total - base[own]
    n_best, count_sum = np.zeros(len(cut), np.int64), np.zeros(len(cut), np.int64)
    np.add.at(n_best, own, times * best[place])
    np.add.at(count_sum, own, times * count[place])
    out = pd.DataFrame([{k: t[k] for k in _TEXT.names} for t in block["texts"]])
    return out.assign(n_best=n_best, count_sum=count_sum)[[f.split(" ")[0] for f in _MEASURES.split(", ")]]


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (first id * 2**32 + second id), ``count`` (links in all texts that hold
    it) and ``best`` (whether no pair of its second id has a higher count)."""
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("count"))
    counts = stored(counts, "pair-counts").withColumn("second", F.col("pair") % F.lit(_PAIR))
    top = counts.groupBy("second").agg(F.max("count").alias("top"))
    return counts.join(top, "second").select("pair", "count", (F.col("count") == F.col("top")).cast("long").alias("best"))


def aligned_blocks(docs: DataFrame, text_col: str = "text", first: str | None = None, second: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The distinct texts in blocks: ``block``, ``pairs`` and ``weights`` (links of each
    pair in all copies of its texts), ``texts`` (digest, copies and measures), and which
    pairs each text holds (``cut``, ``steps``, ``times``)."""
    text = F.col(quoted(text_col)).cast("string").alias("text")
    whole = docs.select(text).where("text is not null and text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    rows = whole.select("text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), "copies")
    return stored(rows.mapInArrow(_blocks(first, second, block_chars), _BLOCK), "blocks")


RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_tokenizers(docs: DataFrame, text_col: str = "text", first: str | None = None, second: str | None = None, block_chars: int = BLOCK_CHARS, hot_least: int = HOT_LEAST) -> DataFrame:
    """How two tokenizers cut every text, and how usual its links are in all texts.

    Adds n_a, n_b (tokens), n_groups (stretches between places where tokens of both
    end), n_links (pairs of tokens that overlap), n_best (links whose pair of ids is the
    most frequent of its second id, ties included), count_sum (sum of the counts of the
    pairs over the links) and groups_sha256 to the columns of ``docs``; clashing names
    are replaced. Texts that are null or empty, or that a tokenizer does not spell byte
    by byte (a space and the text), have no tokens: zeros and an empty digest. Repeated
    rows give repeated results and count each; no rows give no rows. ``first`` and
    ``second`` are paths of a byte-level vocabulary and a piece model on every worker.
    """
    blocks = aligned_blocks(docs, text_col, first, second, block_chars)
    counts = stored(pair_counts(blocks), "counts")
    fetched = blocks.select(F.col("block").alias("asker"), F.explode("pairs").alias("pair")).join(counts, "pair")
    held = blocks.select("block", "pairs", "texts", "cut", "steps", "times")
    measures = stored(held.groupBy("block").cogroup(fetched.groupBy("asker")).applyInPandas(_judged, _MEASURES), "measures")
    kept = without(docs, [*RESULTS, "__llm_digest", "__llm_copy"])
    digest = F.unhex(F.sha2(F.col(quoted(text_col)).cast("string").cast("binary"), 256))
    rows = docs.select(*[F.col(quoted(c)) for c in kept], digest.alias("__llm_digest"))
    # documents of a hot text are dealt to copies of its measures
    total = measures.agg(F.sum("copies")).first()[0] or 0
    share = max(hot_least, -(-total // HOT_PART))
    spread = F.ceil(F.col("copies") / share).cast("int")
    hot = measures.where(F.col("copies") > share).select(F.col("digest").alias("__llm_digest"), spread.alias("__llm_spread"))  # fewer than HOT_PART rows
    rows = rows.join(F.broadcast(hot), "__llm_digest", "left")
    rows = rows.withColumn("__llm_copy", F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__llm_spread")).cast("int"), F.lit(0)))
    laid = measures.select(F.col("digest").alias("__llm_digest"), F.explode(F.sequence(F.lit(0), F.when(F.col("copies") > share, spread - 1).otherwise(0))).alias("__llm_copy"), *RESULTS)
    joined = rows.join(laid, ["__llm_digest", "__llm_copy"], "left")
    none = {"groups_sha256": F.lit("")}
    return joined.select(*[F.col(quoted(c)) for c in kept], *[F.coalesce(F.col(c), none.get(c, F.lit(0).cast("long"))).alias(c) for c in RESULTS])
