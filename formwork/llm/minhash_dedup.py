"""Near-duplicate documents by ProbMinHash over weighted shingles.

A document is the multiset of its runs of ``SHINGLE`` words. Every distinct shingle
sends arrivals to the registers: exponential waiting times, shortened by its weight (its
count), to registers in an order of its own, each register once; a shingle stops when
its next arrival is later than the latest register. The shingle that reaches a register
first is its sample, and two documents agree in a register with the probability Jaccard
similarity of their weighted shingles. ``BANDS`` bands of ``ROWS`` registers give keys.

Equal texts are taken as one. Of every key's texts each is compared with the one that
shares most keys in all (of a family of copies: the text they come from). After the
components of these links are known, the texts of a key that spans several components
are compared across them, inside groups of bounded size: small keys travel together, a
key with more than ``BLOCK`` texts or ``BLOCK_BYTES`` is cut into blocks and each pair of
blocks is a group.
So no pair within a component is enumerated, no pair is written out, and no link between
different components is left out. Every comparison is exact: the probability Jaccard
similarity of the two texts must reach ``SIMILARITY``.

At similarity 0.8 the keys miss a pair with probability 3e-5, at 0.85 with 5e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formwork.llm.frames import quoted, released, slices, stored, utf8
from formwork.llm.graph import components, roots
from formwork.llm.substring_dedup import PIECE_BYTES, WindowHasher

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
#: A prime of at least BANDS * ROWS: shingles visit the registers in steps modulo it.
REGISTERS = 83
#: Texts of a block and their bytes, and rows that travel together: memory of a task. A
#: text of a key with n texts travels to n / BLOCK groups.
BLOCK = 512
BLOCK_BYTES = 4_000_000
GROUP = 4_000
GROUP_BYTES = 64_000_000
#: Texts whose shingles a group keeps at hand.
HELD = 1024

#: Bits (a power of two) of the bitmap that sorts out texts before they are shuffled: 8 MB
#: at any input size. More texts than bits let more through, never less.
NEEDED_BITS = 1 << 26

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Hashes of the shingles of texts; a text of fewer words is one shingle."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size, self.hasher = size, WindowHasher(size)

    def of(self, data: bytes) -> np.ndarray:
        words = np.concatenate([self.hasher.words(x)[1] for x in _cut(data)])
        return self._from(words)

    def _from(self, words: np.ndarray) -> np.ndarray:
        if len(words) >= self.size or not len(words):
            return self.hasher.windows(words)
        few = WindowHasher(len(words))
        return few.windows(words) + np.uint64(len(words))

    def batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(shingle hashes, text index) of a few texts at once."""
        data = b"\n".join(texts)
        at, words = self.hasher.words(data)
        counts = np.diff(np.searchsorted(at, np.cumsum([len(t) + 1 for t in texts])), prepend=0)
        h = self.hasher.windows(words)
        ends = np.cumsum(counts)
        of = np.repeat(np.arange(len(texts)), counts)
        whole = np.arange(len(h)) + self.size <= ends[of[: len(h)]]
        h, doc = h[whole], of[: len(h)][whole]
        short = np.flatnonzero((counts > 0) & (counts < self.size))
        if len(short):
            more = [self._from(words[ends[i] - counts[i] : ends[i]]) for i in short]
            h, doc = np.concatenate([h, *more]), np.concatenate([doc, short])
        return h, doc


def _cut(data: bytes) -> Iterator[bytes]:
    from formwork.llm.substring_dedup import _pieces

    return _pieces(data) if len(data) > PIECE_BYTES else iter((data,))


def prob_min_hash(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """The sample of every register of every document (rows; 0 where it has none) from
    distinct elements with weights, by arrivals with early termination."""
    best = np.full(n_docs * registers, np.inf)
    sample = np.zeros(n_docs * registers, np.uint64)
    start = (_mix(element ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(registers)).astype(np.int64)
    step = (_mix(element ^ np.uint64(0x5C5C5C5C5C5C5C5C)) % np.uint64(registers - 1)).astype(np.int64) + 1
    time = np.zeros(len(element))
    latest = np.full(n_docs, np.inf)
    for i in range(registers):
        u = ((_mix(element + np.uint64((i + 1) * int(_GOLDEN) & (1 << 64) - 1)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(u) * registers / (weight * (registers - i))
        early = time < latest[doc]
        element, weight, doc, start, step, time = (x[early] for x in (element, weight, doc, start, step, time))
        if not len(element):
            break
        cell = doc * registers + (start + i * step) % registers
        first = np.flatnonzero(time < best[cell])
        first = first[np.argsort(-time[first], kind="stable")]  # the earliest is written last
        best[cell[first]] = time[first]
        sample[cell[first]] = element[first]
        latest = best.reshape(n_docs, registers).max(axis=1)
    return sample.reshape(n_docs, registers)


def band_keys(samples: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    key = np.tile(np.arange(bands, dtype=np.uint64) * _GOLDEN, (len(samples), 1))
    cells = samples[:, : bands * rows].reshape(len(samples), bands, rows)
    for r in range(rows):
        key = _mix((key ^ cells[:, :, r]) * _GOLDEN)
    return key.astype(np.int64)


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Exact probability Jaccard similarity of two multisets of shingle hashes."""
    ea, wa = np.unique(a, return_counts=True)
    eb, wb = np.unique(b, return_counts=True)
    both, ia, ib = np.intersect1d(ea, eb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = wa[ia].astype(float), wb[ib].astype(float)
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    # sum of max(x', r y') over the common ones: y' below the ratio r, x' from it on
    values, first = np.unique(ratio[order], return_index=True)
    low_y = np.concatenate(([0.0], np.cumsum(y[order])))[first]
    high_x = x.sum() - np.concatenate(([0.0], np.cumsum(x[order])))[first]
    total = only_a + values * only_b + values * low_y + high_x
    return float((x[order] / np.repeat(total, np.diff(np.append(first, len(order))))).sum())


_KEYS = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.BinaryType()), T.StructField("keys", T.BinaryType()), T.StructField("bytes", T.LongType())])


def _signed(size: int, bands: int, rows: int):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in slices(texts):
                data = [utf8(t) for t in texts[a:b]]
                long = [i for i, t in enumerate(data) if len(t) > PIECE_BYTES]
                h, doc = shingler.batch([b"" if i in long else t for i, t in enumerate(data)])
                for i in long:
                    more = shingler.of(data[i])
                    h, doc = np.concatenate([h, more]), np.concatenate([doc, np.full(len(more), i)])
                order = np.argsort(h ^ _mix(doc.astype(np.uint64)), kind="stable")
                h, doc = h[order], doc[order]
                new = np.concatenate(([True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, bool)
                at = np.flatnonzero(new)
                weight = np.diff(np.append(at, len(h))).astype(float)
                keys = band_keys(prob_min_hash(h[at], weight, doc[at], len(data)), bands, rows)
                some = np.bincount(doc, minlength=len(data)) > 0
                packed = pa.array([k.tobytes() if s else None for k, s in zip(keys, some)], pa.binary())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed, pa.array([len(t) for t in data], pa.int64())], names=_KEYS.names)

    return run


@released
def _pressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for a, b in slices(texts := batch.column(1).to_pylist()):
            yield pa.RecordBatch.from_arrays([batch.slice(a, b - a).column(0), pa.array([press.compress(utf8(t)) for t in texts[a:b]], pa.binary())], names=["d", "z"])


def _verified(size: int, least: float):
    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, press = Shingler(size), zstandard.ZstdDecompressor()
        held: dict[bytes, np.ndarray] = {}

        def shingles(d: bytes, z: bytes) -> np.ndarray:
            if d not in held:
                if len(held) >= 64:
                    held.clear()
                held[d] = shingler.of(press.decompress(z))
            return held[d]

        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = zip(*(part.column(i).to_pylist() for i in range(4)))
                near = [probability_jaccard(shingles(p, zp), shingler.of(press.decompress(zq))) >= least for p, q, zp, zq in rows]
                yield pa.RecordBatch.from_arrays(part.columns[:2], names=["p", "q"]).filter(pa.array(near, pa.bool_()))

    return run


_PAIR = T.StructType([T.StructField("p", T.BinaryType()), T.StructField("q", T.BinaryType())])


def _links(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs (p, q) of texts that are similar enough."""
    left = texts.select(F.col("d").alias("p"), F.col("z").alias("zp"))
    right = texts.select(F.col("d").alias("q"), F.col("z").alias("zq"))
    rows = pairs.join(right, "q").join(left, "p").select("p", "q", "zp", "zq")
    return rows.mapInArrow(_verified(size, least), _PAIR)


_JOINED = T.StructType([T.StructField("p", T.BinaryType()), T.StructField("q", T.BinaryType())])


def _shared_mass(elements: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair (i, j): number of common elements, and the share of i's weight on
    elements of j. Elements of one text only are left out, the rest goes in slices."""
    n = len(elements)
    flat, doc, weight = np.concatenate(elements), np.repeat(np.arange(n), [len(e) for e in elements]), np.concatenate(weights)
    _, column, df = np.unique(flat, return_inverse=True, return_counts=True)
    common = df[column] > 1
    _, column = np.unique(column[common], return_inverse=True)
    doc, weight = doc[common], weight[common]
    order = np.argsort(column, kind="stable")
    column, doc, weight = column[order], doc[order], weight[order]
    count, mass = np.zeros((n, n), np.float32), np.zeros((n, n))
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (at, at + width))
        has = np.zeros((n, width), np.float32)
        has[doc[a:b], column[a:b] - at] = 1
        count += has @ has.T
        share = np.zeros((n, width), np.float32)
        share[doc[a:b], column[a:b] - at] = weight[a:b]
        mass += share @ has.T
    return count, mass


def _near_pairs(shingles: list[np.ndarray], wanted: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The wanted pairs i < j whose similarity reaches ``least``.

    With all weights 1 the similarity is common / all elements. Else it is at most the
    share of either weight on common elements; what passes that is computed exactly."""
    sets = [np.unique(x, return_counts=True) for x in shingles]
    size = np.array([len(e) for e, _ in sets], float)
    total = np.array([w.sum() for _, w in sets], float)
    count, mass = _shared_mass([e for e, _ in sets], [w.astype(np.float32) for _, w in sets])
    mass /= total[:, None]
    even = size == total
    both = even[:, None] & even[None, :]
    plain = count / (size[:, None] + size[None, :] - count) >= least
    maybe = np.minimum(mass, mass.T) >= least - 1e-4
    i, j = np.nonzero(np.triu(wanted & np.where(both, plain, maybe), 1))
    sure = np.array([both[a, b] or probability_jaccard(shingles[a], shingles[b]) >= least for a, b in zip(i, j)], bool)
    return (i[sure], j[sure]) if len(i) else (i, j)


def _across(size: int, least: float):
    """Components that the texts of each (key, pair of blocks) of a group join: one link
    from a component to the smallest one it is joined with."""

    def run(members: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        shingler, press = Shingler(size), zstandard.ZstdDecompressor()
        packed, own_keys = dict(zip(texts["e"], texts["z"])), dict(zip(texts["e"], texts["keys"]))
        held: dict[bytes, np.ndarray] = {}
        found: set[tuple[bytes, bytes]] = set()
        for _, part in members.groupby(["key", "x", "y"], sort=True):
            labels, label = np.unique(part["label"].to_numpy(), return_inverse=True)
            if len(labels) < 2:
                continue
            ds, band = part["d"].tolist(), int(part["band"].iat[0])
            if len(held) > HELD:
                held.clear()
            for d in ds:
                if d not in held:
                    held[d] = shingler.of(press.decompress(packed[d]))
            here = [held[d] for d in ds]
            blk, x, y = part["blk"].to_numpy(), part["x"].iat[0], part["y"].iat[0]
            wanted = label[:, None] != label[None, :]
            if x != y:
                wanted &= blk[:, None] != blk[None, :]
            keys = np.array([np.frombuffer(k, np.int64, band) for k in map(own_keys.get, ds)]).reshape(len(ds), band)
            for k in range(band):  # pairs that share an earlier key are compared there
                wanted &= keys[:, None, k] != keys[None, :, k]
            if not wanted.any():
                continue
            i, j = _near_pairs(here, wanted, least)
            root = roots(len(labels), label[i], label[j])
            found.update((labels[r], labels[c]) for c, r in enumerate(root) if r != c)
        return pd.DataFrame({"p": [p for p, _ in found], "q": [q for _, q in found]})

    return run


def _only_near(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """The rows whose digest d may be among the needed ones: their bit is set."""
    bit = F.pmod(F.xxhash64("d"), F.lit(NEEDED_BITS)) + 1
    maps = needed.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    at = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(bit) == F.col("part")) & (F.pmod((byte / F.pow(F.lit(2), at % 8)).cast("int"), F.lit(2)) == 1), "left_semi")


def _owned(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows (id, digest d, text), and the digest, smallest id and component of every
    distinct text with words."""
    text = F.col(quoted(text_col)).cast("string")
    rows_ = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.unhex(F.md5(text)).alias("d"), text.alias("text"))
    signed = rows_.mapInArrow(_signed(size, bands, rows), _KEYS)
    unique = stored(signed.where("keys is not null").groupBy("d").agg(F.min("id").alias("id"), F.first("keys").alias("keys"), F.first("bytes").alias("bytes")), "unique")
    entries = unique.select("d", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "keys").select("d", "band", F.xxhash64("band", F.substring("keys", F.col("band") * 8 + 1, 8)).alias("key"))
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(entries.join(counts, "key").select("key", "band", "d", "n"), "shared")
    degree = shared.groupBy("d").agg(F.sum("n").alias("degree"))
    best = shared.join(degree, "d").groupBy("key").agg(F.max(F.struct("degree", "d")).alias("hub")).select("key", F.col("hub.d").alias("hub"))
    hubs = stored(best, "hubs")
    pairs = stored(shared.join(hubs, "key").where("d != hub").select(F.col("hub").alias("p"), F.col("d").alias("q")).distinct(), "pairs")
    needed = stored(pairs.select(F.col("p").alias("d")).union(pairs.select(F.col("q").alias("d"))).distinct(), "needed")
    pressed = _only_near(rows_.select("d", "text").where("d is not null"), needed).mapInArrow(_pressed, T.StructType([T.StructField("d", T.BinaryType()), T.StructField("z", T.BinaryType())]))
    texts = stored(pressed.groupBy("d").agg(F.first("z").alias("z")).join(needed, "d", "left_semi").join(unique.select("d", "keys"), "d"), "texts")
    links = stored(_links(pairs, texts, size, least), "links")
    # texts that share a key but no component so far
    label = components(links, "p", "q").withColumnRenamed("vertex", "d")
    member = stored(shared.join(unique.select("d", "bytes"), "d").join(label, "d", "left").select("key", "band", "d", "bytes", F.coalesce("component", "d").alias("label")), "member")
    mixed = member.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).where("a != b")
    blocks = F.least(F.col("n"), F.ceil(F.greatest(F.col("n") / block, F.col("bytes") / block_bytes))).cast("int")
    mixed = stored(mixed.join(hubs, "key").select("key", "hub", "n", "bytes", blocks.alias("blocks")), "mixed")
    n, size_all = (x or 0 for x in mixed.agg(F.sum("n"), F.sum("bytes")).first())
    spread = member.drop("bytes").join(mixed.drop("n", "bytes"), "key").withColumn("blk", F.pmod(F.xxhash64("d"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("x", F.least("blk", "o")).withColumn("y", F.greatest("blk", "o"))
    # small keys of one hub (at most one for each band) travel together: they hold much
    # the same texts, and a text is sent once to a group
    group = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("hub"), F.lit(n // GROUP + size_all // GROUP_BYTES + 1))).otherwise(F.xxhash64("key", "x", "y"))
    spread = stored(spread.withColumn("g", group).select("g", "key", "band", "d", "label", "blk", "x", "y"), "spread")
    sent = spread.select(F.col("g").alias("to"), F.col("d").alias("e")).distinct()
    sent = sent.join(texts.withColumnRenamed("d", "e"), "e")
    joined = spread.groupBy("g").cogroup(sent.groupBy("to")).applyInPandas(_across(size, least), _JOINED)
    links = links.unionByName(stored(joined, "joined"))
    final = components(links, "p", "q").withColumnRenamed("vertex", "d")
    owned = unique.select("d", "id").join(final, "d", "left").select("d", "id", F.coalesce("component", "d").alias("component"))
    return rows_, owned


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The class of every document: documents linked by similarity, directly or through
    others.

    Returns one row per row of ``docs``: the id, ``component_id`` (the smallest id of
    its class, its own included) and ``kept`` (id = component_id). Ids are integers.
    Null, empty and blank texts are in no class but their own and kept; equal texts are
    in one class, so of rows that repeat id and text each has the same result. Rows
    without an id take part, and are kept only in a class without any id. No rows give
    no rows; other columns are not read.
    """
    rows_, owned = _owned(docs, id_col, text_col, size, least, bands, rows, block, block_bytes)
    ids = docs.schema[id_col].dataType
    smallest = owned.groupBy("component").agg(F.min("id").alias("smallest"))
    classes = owned.join(smallest, "component").select(F.col("d").alias("e"), "smallest")
    out = rows_.select("id", "d").join(classes, F.col("d") == F.col("e"), "left")
    found = F.col("e").isNotNull()
    component = F.when(found, F.col("smallest")).otherwise(F.col("id"))
    return out.select(F.col("id").cast(ids).alias(id_col), component.cast(ids).alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """``docs`` with one row of every class: the one with the smallest id, of several
    texts with that id (or of a class without any id) the text with the smallest digest.
    Of rows that repeat id and text one stays; an id that is shared by texts of different
    classes, or missing, has no effect on the others. Texts without words all stay.
    ``docs`` is read several times and should be a table."""
    rows_, owned = _owned(docs, id_col, text_col, **parameters)
    # null ids last; a row goes unless it has both the id and the text that stay
    stay = owned.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "d")).alias("stay"))
    stay = owned.join(stay, "component").select(F.col("d").alias("e"), "stay")
    gone = rows_.select("id", "d").join(stay, F.col("d") == F.col("e")).where(~(F.col("id").eqNullSafe(F.col("stay.id")) & (F.col("d") == F.col("stay.d"))))
    gone = gone.select(F.col("id").alias("__llm_gone_id"), F.col("d").alias("__llm_gone_d")).distinct()
    text = F.col(quoted(text_col)).cast("string")
    d = F.coalesce(F.unhex(F.md5(text)), F.lit(b"")).alias("__llm_d")
    words = F.coalesce(text, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = F.col(quoted(id_col)).cast("long").eqNullSafe(F.col("__llm_gone_id")) & (F.col("__llm_d") == F.col("__llm_gone_d"))
    rest = docs.where(words).select("*", d).join(gone, same, "left_anti")
    return rest.dropDuplicates([id_col, "__llm_d"]).drop("__llm_d").unionByName(docs.where(~words))
