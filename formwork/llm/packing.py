"""Best-fit packing of token pieces into sequences, by large-item matching.

Only the lengths decide where pieces go, and there are at most ``capacity`` different
ones. So Spark counts the pieces of each length, the packing is worked out on these
counts (at most ``capacity`` numbers, whatever the input), and the pieces of each length
are numbered and dealt to the places planned for that length.

The plan: lengths above one third of the capacity are matched greedily, each largest
one with the largest that still fits, so a sequence holds at most two of them; smaller
lengths, longest first, go to the smallest gap that holds them, and open a new sequence
when no gap does.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from formwork.llm.frames import SLICE_ROWS, quoted, released, slices, without
from formwork.llm.tokens import SPLIT, Vocabulary, vocabulary_path

CAPACITY = 2048
END_OF_DOCUMENT = 0
#: Parts into which the pieces of one length are dealt to be numbered.
PARTS = 256


@lru_cache(maxsize=2)
def token_encoder(path: str) -> Callable[[str], bytes]:
    """Encoder of one vocabulary file, made once per Python worker: a text to its ids as
    little-endian 32-bit integers. It remembers no texts, so a worker that goes on to
    other tasks holds no more than the vocabulary."""
    import tiktoken

    v = Vocabulary(path)
    bpe = tiktoken.Encoding("vocabulary", pat_str=SPLIT.pattern, mergeable_ranks=v.ids, special_tokens={})

    def encode(text: str) -> bytes:
        for token, i in v.special.items():
            if token in text:
                return i.to_bytes(4, "little").join([encode(part) for part in text.split(token)])
        ids = bpe.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    return encode


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: only longer ones than ``capacity`` are
    cut, all pieces but the first are full."""
    if n <= capacity:
        return [n]
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


PIECES = T.StructType([
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def token_pieces(docs: DataFrame, text_col: str = "text", capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Every text as token pieces of at most ``capacity`` tokens, the last token being
    the end of the document (id 0).

    Returns one row per piece: the other columns of ``docs`` (clashing names are
    replaced), ``piece`` (from 0), ``start`` (tokens before it), ``length`` and ``ids``
    (little-endian unsigned 32-bit). Null and empty texts have one piece of one token.
    """
    kept = without(docs, [*PIECES.names, text_col])
    inner = docs.select(*[F.col(quoted(c)) for c in kept], F.col(quoted(text_col)).cast("string").alias("__llm_text"))
    schema = T.StructType([*inner.schema.fields[:-1], *PIECES.fields])
    kinds = [f.type for f in to_arrow_schema(PIECES)]
    end = int(END_OF_DOCUMENT).to_bytes(4, "little")

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_encoder(vocabulary or vocabulary_path())
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            for a, b in slices(texts := batch.column(batch.num_columns - 1).to_pylist()):
                rows, of = [], []
                for i in range(a, b):
                    ids = encode(texts[i] or "") + end
                    at = 0
                    for piece, n in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        rows.append((piece, at, n, ids[4 * at : 4 * (at + n)]))
                        of.append(i)
                        at += n
                rest = batch.take(pa.array(of, pa.int64())).columns[:-1]
                yield pa.RecordBatch.from_arrays([*rest, *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]], names=schema.names)

    return inner.mapInArrow(run, schema)


@dataclass
class _Bins:
    """``n`` sequences filled alike: runs of (length, times), and the gap left."""

    n: int
    gap: int
    runs: list[tuple[int, int]] = field(default_factory=list)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[_Bins]:
    """Groups of equally filled sequences for ``counts`` pieces of each length."""
    left = {s: n for s, n in counts.items() if n}
    done: list[_Bins] = []
    gaps: dict[int, list[_Bins]] = {}
    order: list[int] = []  # gaps in use, ascending

    def put(b: _Bins) -> None:
        if not b.n:
            return
        if not b.gap:
            done.append(b)
            return
        if b.gap not in gaps:
            gaps[b.gap] = []
            insort(order, b.gap)
        gaps[b.gap].append(b)

    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        i = bisect_left(large, capacity - a + 1) - 1  # the largest that fits beside it
        if i < 0:
            put(_Bins(left[a], capacity - a, [(a, 1)]))
            large.pop()
            continue
        b = large[i]
        if a == b:
            put(_Bins(left[a] // 2, capacity - 2 * a, [(a, 2)]))
            left[a] %= 2
            if left[a]:
                j = i - 1
                if j >= 0:  # the odd one goes with the next smaller length
                    c = large[j]
                    put(_Bins(1, capacity - a - c, [(a, 1), (c, 1)]))
                    left[c] -= 1
                    if not left[c]:
                        large.pop(j)
                else:
                    put(_Bins(1, capacity - a, [(a, 1)]))
            large.remove(a)
            continue
        n = min(left[a], left[b])
        put(_Bins(n, capacity - a - b, [(a, 1), (b, 1)]))
        for s in (a, b):
            left[s] -= n
            if not left[s]:
                large.remove(s)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            i = bisect_left(order, s)
            if i == len(order):
                each = capacity // s
                put(_Bins(n // each, capacity - each * s, [(s, each)]))
                if n % each:
                    put(_Bins(1, capacity - n % each * s, [(s, n % each)]))
                break
            group = gaps[order[i]]
            b = group.pop()
            if not group:
                del gaps[order.pop(i)]
            each = b.gap // s
            full = min(b.n, n // each)
            put(_Bins(full, b.gap - each * s, [*b.runs, (s, each)]))
            n -= full * each
            rest = b.n - full
            if rest and n:
                put(_Bins(1, b.gap - n * s, [*b.runs, (s, n)]))
                n, rest = 0, rest - 1
            put(_Bins(rest, b.gap, b.runs))
    for group in gaps.values():
        done += group
    return done


@dataclass
class Places:
    """The plan as intervals of piece numbers per length, sorted by (length, first)."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    _shift: int = 46

    @classmethod
    def of(cls, bins: list[_Bins]) -> Places:
        rows, used, sequence = [], {}, 0
        for b in bins:
            at = 0
            for s, each in b.runs:
                rows.append((s, used.get(s, 0), each, sequence, at))
                used[s] = used.get(s, 0) + each * b.n
                at += s * each
            sequence += b.n
        rows.sort()
        return cls(*(np.array([r[i] for r in rows], np.int64) for i in range(5)))

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of piece ``number`` (from 0) of each length."""
        i = np.searchsorted((self.length << self._shift) + self.first, (length << self._shift) + number, "right") - 1
        k = number - self.first[i]
        return self.sequence[i] + k // self.each[i], self.offset[i] + k % self.each[i] * length


NEW = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def best_fit_pack(pieces: DataFrame, key: list[str], length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Deal pieces of 1..capacity tokens to sequences of at most ``capacity``.

    Adds ``sequence_id`` and ``offset`` (clashing names are replaced); offsets of a
    sequence leave no gap from 0. ``key`` names the columns that tell pieces apart; rows
    equal in them are interchangeable and still get places of their own. ``pieces`` is
    read twice and should be a table. No rows give no rows; a null, zero or too large
    length raises. The plan that travels with the tasks has at most a few entries per
    length, whatever the number of pieces.
    """
    spark = pieces.sparkSession
    size = F.col(quoted(length_col)).cast("long")
    counts = {r["s"]: r["n"] for r in pieces.groupBy(size.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(s is None or not 0 < s <= capacity for s in counts):
        raise ValueError(f"lengths must be 1..{capacity}")
    if not counts:
        return spark.createDataFrame([], T.StructType([*[pieces.schema[c] for c in without(pieces, NEW.names)], *NEW.fields]))
    places = Places.of(plan(counts, capacity))
    kept = without(pieces, NEW.names)
    part = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in key]), F.lit(PARTS)).cast("int")
    rows = pieces.select(*[F.col(quoted(c)) for c in kept], size.alias("__llm_size"), part.alias("__llm_part"))
    before = (
        pieces.groupBy(size.alias("__llm_size"), part.alias("__llm_part"))
        .agg(F.count(F.lit(1)).alias("__llm_n"))
        .withColumn("__llm_before", F.sum("__llm_n").over(Window.partitionBy("__llm_size").orderBy("__llm_part")) - F.col("__llm_n"))
        .drop("__llm_n")
    )
    within = Window.partitionBy("__llm_size", "__llm_part").orderBy(*[F.col(quoted(c)) for c in key])
    numbered = rows.withColumn("__llm_k", F.row_number().over(within)).join(before, ["__llm_size", "__llm_part"])
    numbered = numbered.select(*[F.col(quoted(c)) for c in kept], "__llm_size", (F.col("__llm_before") + F.col("__llm_k") - 1).alias("__llm_number"))
    schema = T.StructType([*[pieces.schema[c] for c in kept], *NEW.fields])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, k = (batch.column(batch.num_columns - i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 1))
            sequence, offset = places.find(s, k)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(sequence), pa.array(offset)], names=schema.names)

    return numbered.mapInArrow(run, schema)


def sequences(packed: DataFrame, ids_col: str = "ids") -> DataFrame:
    """The packed sequences: ``sequence_id`` and its ``ids``, pieces in offset order."""
    placed = F.array_sort(F.collect_list(F.struct("offset", F.col(quoted(ids_col)).alias("ids"))))
    return packed.groupBy("sequence_id").agg(placed.alias("p")).select("sequence_id", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"))
