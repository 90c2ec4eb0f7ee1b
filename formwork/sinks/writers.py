"""Sinks: files (K1), catalog tables (K2), versioned snapshots written only on change
(K3) and GeoJSON lines (K8)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from formwork.functions.coerce import flatten_for_text
from formwork.operators.columns import q
from formwork.operators.fingerprint import fingerprint_columns, fingerprint_of
from formwork.operators.geo import geojson_feature
from formwork.operators.validate import check_table_schema, table_columns
from formwork.sources.readers import CSV_DIALECT

FORMATS = ("csv", "parquet", "json")
MANIFEST = "_versions"
MANIFEST_SCHEMA = "name string, rows long, fingerprint string, number int"
CLAIMS = "_claims"
STAGED = "_staged"
CSV_WRITING = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": '""', "nullValue": ""}


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """A5 without a second pass: the row count is observed while the frame is written."""
    obs = Observation("rows_written")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def _save(out: DataFrame, path: str, fmt: str, mode: str) -> None:
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.options(**CSV_DIALECT, **CSV_WRITING).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.json(path)


def _checked_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {FORMATS}")


def write_file(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> int:
    """K1: CSV (with header; nested, temporal and boolean columns flattened first, F17;
    dialect ``CSV_DIALECT``, blanks kept, null and empty text told apart), Parquet or
    JSON lines. The output is a folder of part files. Returns the number of rows
    written, counted during the write."""
    _checked_format(fmt)
    out, obs = _counted(flatten_for_text(df) if fmt == "csv" else df)
    _save(out, path, fmt, mode)
    return int(obs.get["rows"])


def write_table(spark: SparkSession, df: DataFrame, table: str, mode: str = "replace") -> int:
    """K2: replace (default) or append a catalog table. Appends are checked first (V5)
    and matched by column name, not position; a column that the frame lacks is null in
    the new rows. Returns the number of rows written."""
    if mode not in ("replace", "append"):
        raise ValueError("mode must be 'replace' or 'append'")
    if mode == "append" and table_columns(spark, table):
        check_table_schema(spark, df, table)
        target = spark.table(table).schema
        missing = F.lit(None)
        out, obs = _counted(df.select(*[(q(f.name) if f.name in df.columns else missing.cast(f.dataType)).alias(f.name) for f in target.fields]))
        out.write.mode("append").saveAsTable(table)
        return int(obs.get["rows"])
    out, obs = _counted(df)
    out.write.mode("overwrite").saveAsTable(table)
    return int(obs.get["rows"])


def append_once(spark: SparkSession, df: DataFrame, table: str, run: str, run_col: str = "run") -> int:
    """K2: append the rows of one run to a table partitioned by ``run_col``; the same run
    appended again, after a failure or by a repeated call, gives its rows once.

    The marker is the partition itself, so it is committed with the rows: a run whose
    partition holds rows is left as it is, and what an unfinished attempt left there is
    replaced. Columns are checked (V5) and matched by name as in ``write_table``.
    Returns the number of rows written (0 for a run that is there already)."""
    marked = df.withColumn(run_col, F.lit(run))
    if not table_columns(spark, table):
        out, obs = _counted(marked)
        out.write.partitionBy(run_col).saveAsTable(table)
        return int(obs.get["rows"])
    check_table_schema(spark, marked, table)
    target = spark.table(table)
    if run_col not in target.columns:
        raise ValueError(f"table {table!r} has no column {run_col!r} for the runs of its appends")
    if not target.where(F.col(run_col) == run).isEmpty():
        return 0
    out, obs = _counted(marked.select(*[(q(f.name) if f.name in marked.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.schema.fields if f.name != run_col]))
    value = "'" + run.replace("\\", "\\\\").replace("'", "\\'").replace("{", "{{").replace("}", "}}") + "'"
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (`{run_col}` = {value}) SELECT * FROM {{rows}}", rows=out)  # that partition alone
    return int(obs.get["rows"])


def _folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _latest_version(spark: SparkSession, root: str) -> Row | None:
    fs, manifest = _folder(spark, f"{root}/{MANIFEST}")
    if not fs.exists(manifest):
        return None
    top = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{root}/{MANIFEST}").orderBy(F.col("number").desc()).limit(1).collect()
    return top[0] if top else None


def _claimed(spark: SparkSession, root: str, first: int) -> int:
    """The first version number from ``first`` on that no writer has claimed: a claim is
    an empty file that is only created where there is none, so two writers never hold
    one number."""
    number = first
    while True:
        fs, mark = _folder(spark, f"{root}/{CLAIMS}/v{number}")
        try:
            fs.create(mark, False).close()
            return number
        except Py4JJavaError:
            if not fs.exists(mark):
                raise
            number += 1


def snapshot_if_changed(spark: SparkSession, df: DataFrame, root: str, fmt: str = "parquet") -> tuple[str, bool]:
    """K3: (version name, written). The content is written once, to a folder of its own,
    and its fingerprint (A7) is observed during that write. If the latest version already
    has this fingerprint the folder is dropped; else the next free version number is
    claimed, the folder becomes ``<root>/v<n+1>`` (``v1`` when none), and only then the
    manifest names it. So a failed write never leaves a version that the manifest names,
    and concurrent writers get versions of their own."""
    _checked_format(fmt)
    root = root.rstrip("/")
    staged = f"{root}/{STAGED}/{uuid.uuid4().hex}"
    obs = Observation("snapshot")
    out = df.observe(obs, *fingerprint_columns(df))
    _save(flatten_for_text(out) if fmt == "csv" else out, staged, fmt, "error")
    rows, fp = fingerprint_of(df, obs.get)
    fs, folder = _folder(spark, staged)
    latest = _latest_version(spark, root)
    if latest is not None and latest["fingerprint"] == fp:
        fs.delete(folder, True)
        return latest["name"], False
    number = _claimed(spark, root, latest["number"] + 1 if latest is not None else 1)
    if not fs.rename(folder, _folder(spark, f"{root}/v{number}")[1]):
        raise RuntimeError(f"the snapshot could not be moved to {root}/v{number}")
    manifest = spark.createDataFrame([(f"v{number}", rows, fp)], "name string, rows long, fingerprint string")
    manifest.coalesce(1).write.parquet(f"{root}/{MANIFEST}/number={number}")  # a folder per writer
    return f"v{number}", True


def write_geojson_lines(df: DataFrame, path: str, geometry_col: str = "geometry", mode: str = "overwrite") -> None:
    """K8: one GeoJSON Feature per line (F8)."""
    geojson_feature(df, geometry_col).write.mode(mode).text(path)
