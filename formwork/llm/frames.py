"""Shared helpers: Arrow batches in and out of tasks, column names, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from formwork.session import scratch_path

#: Rows handed to a text function at once, and characters after which a smaller slice
#: is handed over; they bound memory only, results do not depend on them.
SLICE_ROWS = 512
SLICE_CHARS = 4_000_000

#: Bytes of rows after which ``small_batches`` sends a batch to a Python worker. Spark's
#: own limits (10,000 rows, 64 MB) send all texts of a task at once.
BATCH_BYTES = 4_000_000
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application: they need not find
    it on a path of their own."""
    sc = spark.sparkContext
    name = f"formwork-{sc.applicationId}.zip"
    if any(f.endswith(name) for f in sc.listFiles):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="formwork-ship-")) / name
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty)."""
    return (text or "").encode("utf-8", "surrogatepass")


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` that do not clash (case-insensitively) with ``names``."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most SLICE_ROWS rows and about SLICE_CHARS."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if i + 1 - start >= SLICE_ROWS or size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def small_batches(spark: SparkSession) -> None:
    """Send rows to Python workers in batches of about ``BATCH_BYTES``, for the rest of
    the session; a limit that the session has set itself stays. A batch is held by the
    executor and by its worker, for every task at once; results do not depend on it."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def released(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``run``, after which the worker gives back the memory of its batches: it waits
    for further tasks beside an executor that may need it."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return whole


def map_text(
    docs: DataFrame,
    text_col: str,
    new: T.StructType,
    make: Callable[[], Callable[[list[str]], Iterable[tuple]]],
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Add columns computed from whole texts, one task per partition, no shuffle.

    ``make`` runs once per task and returns a function from a list of texts (nulls as
    empty texts) to one tuple per text in the order of ``new``. Input columns stay; one
    whose name clashes with a new column is replaced by it. ``keep`` narrows the input
    columns that are passed on.
    """
    kept = without(docs.select(*[F.col(quoted(c)) for c in keep]) if keep is not None else docs, new.names)
    inner = docs.select(*[F.col(quoted(c)) for c in kept], F.col(quoted(text_col)).cast("string").alias("__llm_text"))
    schema = T.StructType([f for f in inner.schema.fields[:-1]] + list(new.fields))
    arrow_new = to_arrow_schema(new)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for a, b in slices(texts := batch.column(batch.num_columns - 1).to_pylist()):
                rows = list(fn([t or "" for t in texts[a:b]]))
                part = batch.slice(a, b - a)
                added = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow_new)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *added], names=schema.names)

    return inner.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: later steps
    start from the files, whatever executors are lost meanwhile."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
