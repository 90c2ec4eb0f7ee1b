"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words, counted
in Spark; repeated windows merge into maximal removal intervals.

Map tasks hash every window of their documents and send the 64-bit hashes, packed in
blocks, to hash ranges (buckets). A window whose hash occurs more than once in one
block is known to repeat there: only one entry per hash and block travels, so a passage
that a third of all rows share adds one entry per block, not per row. Each bucket
counts its hashes and returns the positions of repeated windows, which join the
documents by row. The number of buckets follows the number of characters, so a bucket
holds about ``BUCKET_WINDOWS`` hashes at any input size.

Windows are hashed by two polynomials of their word hashes modulo the prime 2**61 - 1. Windows are taken for equal when 80 bits of both agree: about n * n / 2**81
false pairs for n windows (1e-8 for a GB of text, 1e-5 for 30 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formwork.llm.frames import quoted, released, utf8, without

WINDOW = 35
BUCKET_WINDOWS = 2_000_000
MIN_BUCKETS = 32
#: Windows per block and bytes hashed at once in a map task: memory only.
BLOCK_WINDOWS = 2_000_000
PIECE_BYTES = 2_000_000

#: Bytes above which a word is hashed on its own.
LONG_WORD = 64

_ALL = (1 << 64) - 1
_PRIME = (1 << 61) - 1
_BASES = (0x1E3779B97F4A7C15, 0x02B2AE3D27D4EB4F)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit numbers modulo the prime."""
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def _times(x: np.ndarray, factor: int) -> np.ndarray:
    """x * factor modulo the prime, from products of halves that fit 64 bits."""
    low, high = x & np.uint64(0x7FFFFFFF), x >> np.uint64(31)
    f_low, f_high = np.uint64(factor & 0x7FFFFFFF), np.uint64(factor >> 31)
    middle = high * f_low + low * f_high
    middle = (middle >> np.uint64(30)) + ((middle & np.uint64(0x3FFFFFFF)) << np.uint64(31))
    return _reduced(low * f_low + middle + ((high * f_high) << np.uint64(1)))


def _word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]: runs of eight bytes are mixed in one after the
    other, for all words at once; long words by BLAKE2."""
    size = ends - starts
    out = _mixed(size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    padded = data + bytes(8)
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    at = np.flatnonzero(size <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        left = np.minimum(size[at] - k, 8).astype(np.uint64) * np.uint64(8)
        out[at] = _mixed(out[at] ^ (eights[starts[at] + k] & (np.uint64(_ALL) >> (np.uint64(64) - left))))
    for i in np.flatnonzero(size > LONG_WORD):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return out


class WindowHasher:
    """Hashes of words and of word windows, a piece of text at a time."""

    def __init__(self, window: int) -> None:
        self.window = window

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start offset and hash of every word of one piece of UTF-8."""
        raw = np.frombuffer(data, np.uint8)
        sep = np.ones(len(raw) + 2, bool)
        sep[1:-1] = _SEPARATOR[raw]
        edge = np.flatnonzero(sep[1:] != sep[:-1])
        starts, ends = edge[::2], edge[1::2]
        return starts, _word_hashes(data, starts, ends)

    def windows(self, words: np.ndarray, lane: int = 0) -> np.ndarray:
        """Mixed Rabin-Karp hash of every window."""
        return _mixed(self.polynomial(words, lane))

    def polynomial(self, words: np.ndarray, lane: int = 0) -> np.ndarray:
        """Sum of word * base**i modulo the prime, highest power first, joined from runs
        of 1, 2, 4, ... words."""
        if len(words) < self.window:
            return np.zeros(0, np.uint64)
        run, size, whole, done, left = _reduced(words), 1, None, 0, self.window
        while True:
            power = pow(_BASES[lane], size, _PRIME)
            if left & 1:
                own = run[done:]
                whole = own if whole is None else _reduced(_times(whole[: len(own)], power) + own)
                done += size
            left >>= 1
            if not left:
                return whole
            run = _reduced(_times(run[:-size], power) + run[size:])
            size *= 2

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 bits to sort every window by, and 16 more to compare."""
        first, second = self.polynomial(words), self.polynomial(words, 1)
        return _mixed(first | (second << np.uint64(61))), (second >> np.uint64(3)).astype(np.uint16)


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text cut before separators, so that no word is split."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = at + PIECE_BYTES
        while cut < len(data) and not _SEPARATOR[data[cut]]:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def _hashed(rows: Iterator[tuple[int, bytes]], hasher: WindowHasher) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row keys, word counts, word hashes) for runs of documents of about PIECE_BYTES."""
    keys: list[int] = []
    held: list[bytes] = []
    size = 0

    def flush():
        data = b"\n".join(held)
        ends = np.cumsum([len(x) + 1 for x in held])
        at, h = hasher.words(data)
        counts = np.diff(np.searchsorted(at, ends), prepend=0)
        return np.array(keys, np.int64), counts, h

    for key, data in rows:
        if len(data) > PIECE_BYTES:
            parts = [hasher.words(x)[1] for x in _pieces(data)]
            yield np.array([key], np.int64), np.array([sum(map(len, parts))]), np.concatenate(parts)
            continue
        keys.append(key)
        held.append(data)
        size += len(data) + 1
        if size >= PIECE_BYTES:
            yield flush()
            keys, held, size = [], [], 0
    if held:
        yield flush()


def _pack(keys: np.ndarray, pos: np.ndarray) -> bytes:
    """Row keys as runs and positions as differences, compressed."""
    if not len(keys):
        return b""
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    runs = np.diff(np.append(new, len(keys))).astype(np.uint32)
    step = np.diff(pos.astype(np.uint32), prepend=np.uint32(0))
    head = np.array([len(new), len(keys)], np.uint32).tobytes()
    planes = step.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + keys[new].tobytes() + runs.tobytes() + planes)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not blob:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n_runs, n = (int(x) for x in np.frombuffer(raw, np.uint32, 2))
    at = 8
    keys = np.frombuffer(raw, np.int64, n_runs, at)
    at += 8 * n_runs
    runs = np.frombuffer(raw, np.uint32, n_runs, at)
    at += 4 * n_runs
    step = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view(np.uint32).ravel()
    return np.repeat(keys, runs), np.cumsum(step, dtype=np.uint32)


def _next_equal(values: np.ndarray) -> np.ndarray:
    return values[1:] == values[:-1]


def _repeats(h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the windows that occur more than once, and of one of each kind."""
    order = np.lexsort((check, h)) if len(h) else np.zeros(0, int)
    same = _next_equal(h[order]) & _next_equal(check[order])
    many, first = np.zeros(len(h), bool), np.ones(len(h), bool)
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    first[order[1:][same]] = False
    return many, first


def _block_rows(h: np.ndarray, check: np.ndarray, keys: np.ndarray, pos: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
    """Rows (bucket, hashes, their check bits, repeated flags, positions) of one block of
    windows; the positions of windows that repeat inside the block go to buckets from -1
    down by row key, once for rows that are equal."""
    many, first = _repeats(h, check)
    known = np.flatnonzero(many)
    part = keys[known] % buckets
    order = np.lexsort((pos[known], keys[known], part))
    known, part = known[order], part[order]
    new = np.ones(len(known), bool)
    new[1:] = (keys[known[1:]] != keys[known[:-1]]) | (pos[known[1:]] != pos[known[:-1]])
    known, part = known[new], part[new]
    for a, b in _runs(part):
        at = known[a:b]
        yield -1 - int(part[a]), b"", b"", b"", _pack(keys[at], pos[at])
    entry = np.flatnonzero(first)
    bucket = h[entry] >> np.uint64(32)
    bucket *= np.uint64(buckets)
    bucket >>= np.uint64(32)
    bucket = bucket.astype(np.uint32)
    by = np.argsort(bucket.astype(np.uint16) if buckets < 65536 else bucket, kind="stable")
    entry, bucket = entry[by], bucket[by]
    for a, b in _runs(bucket):
        at = entry[a:b]
        yield int(bucket[a]), h[at].tobytes(), check[at].tobytes(), np.packbits(many[at]).tobytes(), _pack(keys[at[~many[at]]], pos[at[~many[at]]])


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Index ranges of equal neighbours."""
    cut = np.flatnonzero(values[1:] != values[:-1]) + 1
    return zip([0, *cut], [*cut, len(values)]) if len(values) else iter(())


_BLOCKS = T.StructType([
    T.StructField("bucket", T.LongType()),
    T.StructField("hashes", T.BinaryType()),
    T.StructField("checks", T.BinaryType()),
    T.StructField("many", T.BinaryType()),
    T.StructField("places", T.BinaryType()),
])


def _send_windows(window: int, buckets: int):
    names = [f.name for f in _BLOCKS.fields]
    kinds = [pa.int64(), *[pa.binary()] * 4]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher(window)
        block: list[tuple[np.ndarray, ...]] = []
        held = 0

        def flush():
            whole = [np.concatenate(x) for x in zip(*block)]
            block.clear()  # not held beside its copy
            for row in _block_rows(*whole, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        rows = ((k, utf8(t)) for batch in batches for part in _rows_of(batch) for k, t in part)
        for keys, counts, words in _hashed(rows, hasher):
            h, check = hasher.keys(words)
            ends = np.cumsum(counts)
            starts = ends - counts
            doc = np.repeat(np.arange(len(keys)), counts)[: len(h)]
            at = np.arange(len(h))
            whole = at + window <= ends[doc]
            at, doc = at[whole], doc[whole]
            if not len(at):
                continue
            block.append((h[at], check[at], keys[doc], (at - starts[doc]).astype(np.uint32)))
            held += len(at)
            if held >= BLOCK_WINDOWS:
                yield from flush()
                held = 0
        if block:
            yield from flush()

    return run


def _rows_of(batch: pa.RecordBatch, step: int = 256):
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        yield list(zip(part.column(0).to_pylist(), part.column(1).to_pylist()))


_PLACES = T.StructType([T.StructField("row", T.LongType()), T.StructField("at", T.BinaryType())])


def _count_bucket(group: pd.DataFrame) -> pd.DataFrame:
    """Positions of the repeated windows of one bucket, one row per document."""
    places = [_unpack(x) for x in group["places"]]
    keys, pos = (np.concatenate([x[i] for x in places]) for i in (0, 1))
    if group["bucket"].iat[0] >= 0:
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in group["hashes"]])
        check = np.concatenate([np.frombuffer(x, np.uint16) for x in group["checks"]])
        many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[: len(x) // 8] for m, x in zip(group["many"], group["hashes"])]).astype(bool)
        again = _repeats(h, check)[0][~many]  # the positions of the others travel apart
        keys, pos = keys[again], pos[again]
    order = np.lexsort((pos, keys))
    keys, pos = keys[order], pos[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (pos[1:] != pos[:-1])  # equal rows have one list
    keys, pos = keys[new], pos[new]
    if not len(keys):
        return pd.DataFrame({"row": np.zeros(0, np.int64), "at": []})
    runs = list(_runs(keys))
    return pd.DataFrame({"row": [keys[a] for a, _ in runs], "at": [pos[a:b].tobytes() for a, b in runs]})


def removal_intervals(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word intervals [start, end) covered by windows beginning at ``starts``."""
    starts = np.unique(starts)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts, prepend=-window - 1) > window)
    last = np.append(cut[1:], len(starts)) - 1
    return [(int(a), int(b) + window) for a, b in zip(starts[cut], starts[last])]


def keep_words(data: bytes, removed: list[tuple[int, int]], layout: str) -> tuple[int, str]:
    """Number of words, and the text without the removed word intervals: its kept words
    joined by one space (``words``) or its bytes without the removed ones (``text``)."""
    words = data.split()
    if layout == "text":
        if not removed:
            return len(words), data.decode("utf-8", "surrogatepass")
        ends = [0]
        for w in words:
            ends.append(data.index(w, ends[-1]) + len(w))
        out, at = [], 0
        for a, b in removed:
            out.append(data[at : ends[a]])
            at = ends[b]
        return len(words), b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")
    kept, at = [], 0
    for a, b in removed:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return len(words), b" ".join(kept).decode("utf-8", "surrogatepass")


def _cut(window: int, layout: str, schema: T.StructType, n_kept: int):
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = list(to_arrow_schema(schema))[n_kept:]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = []
                for packed, at in zip(part.column(n_kept).to_pylist(), part.column(n_kept + 1).to_pylist()):
                    data = zstandard.ZstdDecompressor().decompress(packed) if packed else b""
                    gone = removal_intervals(np.concatenate([np.frombuffer(x, np.uint32) for x in at]).astype(np.int64), window) if at else []
                    n, text = keep_words(data, gone, layout)
                    rows.append((n, sum(e - s for s, e in gone), [{"start": s, "end": e} for s, e in gone], text))
                new = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *new], names=schema.names)

    return run


@released
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column (text) as compressed bytes: less to shuffle."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            packed = pa.array([press.compress(utf8(t)) if t else b"" for t in part.column(part.num_columns - 1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], packed], names=part.schema.names)


NEW = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("kept_text", T.StringType()),
])


def remove_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, layout: str = "words", bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that starts more than
    once in all texts (the same document included).

    Returns the columns of ``docs`` without the text (a clashing name is replaced) and
    ``n_words``, ``n_removed``, ``removed`` (maximal word intervals, end exclusive) and
    ``kept_text`` (see ``keep_words``). Words are runs of characters other than space
    and \\t..\\r. Null and empty texts have no words; texts shorter than the window keep
    all; repeated rows repeat each other, so their windows go from each; an empty
    table gives an empty result. Null ids are kept as they are.
    """
    kept = without(docs, [*NEW.names, text_col])
    text = F.col(quoted(text_col)).cast("string")
    row = F.xxhash64(F.col(quoted(id_col)), text)
    chars = docs.agg(F.sum(F.length(text))).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-chars // 6 // bucket_windows))
    blocks = docs.select(row.alias("row"), text.alias("text")).mapInArrow(_send_windows(window, buckets), _BLOCKS)
    places = blocks.groupBy("bucket").applyInPandas(_count_bucket, _PLACES)
    places = places.groupBy(F.col("row").alias("__llm_place")).agg(F.collect_list("at").alias("__llm_at"))
    packed_schema = T.StructType([T.StructField("__llm_row", T.LongType()), *[docs.schema[c] for c in kept], T.StructField("__llm_text", T.BinaryType())])
    packed = docs.select(row.alias("__llm_row"), *[F.col(quoted(c)) for c in kept], text.alias("__llm_text")).mapInArrow(_packed, packed_schema)
    joined = packed.join(places, F.col("__llm_row") == F.col("__llm_place"), "left").select(*[F.col(quoted(c)) for c in kept], "__llm_text", "__llm_at")
    schema = T.StructType([*[docs.schema[c] for c in kept], *NEW.fields])
    return joined.mapInArrow(_cut(window, layout, schema, len(kept)), schema)
