"""Sources: submission files (S1), one form's submissions (S2), the org-unit export (S3),
metadata documents (S4), form definitions (S5), table columns (S6) and geometries (S7).

The reference pulls these over HTTP; here they are files or tables already landed on
shared storage. Filters are written as DataFrame predicates so they reach the Parquet
scan (``PushedFilters``) and only the needed columns are read.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType, StringType, StructField, StructType

from formwork.functions.text import strip_strings
from formwork.operators.forms import latest_version
from formwork.sources.csv_records import csv_records

SUBMISSION_SUFFIXES = (".csv", ".parquet")

# Schema of a metadata document: one row per form version.
METADATA_SCHEMA = (
    "form_id string, version string, "
    "questions map<string, struct<name: string, type: string, label: string, calculate: string>>, "
    "choices map<string, array<struct<name: string, label: string>>>"
)


def _read(reader, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise FileNotFoundError(path) from exc
        raise


#: How CSV files are written and read: quotes doubled inside quotes, line breaks allowed
#: there, blanks kept; an unquoted empty field is null, a quoted one an empty text.
CSV_DIALECT = {"header": "true", "quote": '"', "escape": '"'}
#: The reader takes a field for null when it equals the null text, quoted or not; so
#: quoted empty fields are read as this mark first.
EMPTY_MARK = "\x00empty\x00"
CSV_PARSING = {k: v for k, v in CSV_DIALECT.items() if k != "header"}
CSV_READING = {"multiLine": "true", "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "emptyValue": EMPTY_MARK, "nullValue": ""}
CSV_PARSING |= CSV_READING


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of CSV files (their first record alone is read)."""
    return _read(spark.read.options(**CSV_DIALECT, **CSV_READING, inferSchema="false").csv, path).columns


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with every column as text, named by its header; large files
    are read in many tasks (``csv_records``)."""
    names = _header(spark, path)
    return _parsed(csv_records(spark, path), names)


def _parsed(records: DataFrame, names: list[str]) -> DataFrame:
    if not names:
        return records.sparkSession.createDataFrame([], StructType([]))
    plain = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
    parsed = records.select(F.from_csv("record", plain.simpleString()[7:-1].replace(":", " "), CSV_PARSING).alias("r"))
    return parsed.select(*[F.when(c == EMPTY_MARK, F.lit("")).otherwise(c).alias(n) for n, c in ((n, F.col(f"r.c{i}")) for i, n in enumerate(names))])


def infer_csv_schema(spark: SparkSession, path: str) -> StructType:
    """Column types inferred over the whole input (one pass; give a schema to save it)."""
    names = _header(spark, path)
    return _inferred(csv_records(spark, path), names)


def _inferred(records: DataFrame, names: list[str]) -> StructType:
    spark = records.sparkSession
    reader = spark._jsparkSession.read()
    for key, value in {**CSV_PARSING, "header": "false", "inferSchema": "true"}.items():
        reader = reader.option(key, value)
    texts = getattr(records._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    found = DataFrame(reader.csv(texts), spark).schema.fields
    return StructType([StructField(n, found[i].dataType if i < len(found) else StringType()) for i, n in enumerate(names)])


def _typed(name: str, data_type, path: str):
    """A CSV text column cast to its type; a non-empty value that does not fit fails
    the job (no silent nulls), in the same pass as the caller's work."""
    text = F.col(f"`{name}`")
    if isinstance(data_type, StringType):
        return text
    typed = text.try_cast(data_type)
    message = F.concat(F.lit(f"unparsable value in {path}, column {name}: "), text)
    return F.when(text.isNotNull() & typed.isNull(), F.raise_error(message)).otherwise(typed).alias(name)


def read_submissions(spark: SparkSession, path: str, schema: StructType | str | None = None, check_empty: bool = True) -> DataFrame:
    """A submissions file chosen by its lower-cased suffix.

    CSV: dialect ``CSV_DIALECT``; columns are matched to ``schema`` by header name, types
    inferred over the whole input unless ``schema`` is given; over-long rows are
    truncated (PERMISSIVE). Parquet as is. Unknown suffix, missing path, a column of the
    schema that the header lacks and no rows raise."""
    lower = path.lower().rstrip("/")
    if lower.endswith(".csv"):
        names = _header(spark, path)
        records = csv_records(spark, path)
        base = schema if schema is not None else _inferred(records, names)
        if isinstance(base, str):
            base = StructType.fromDDL(base)
        raw = _parsed(records, names)
        if absent := [f.name for f in base.fields if f.name not in raw.columns]:
            raise ValueError(f"{path!r} has no column {absent}")
        df = raw.select(*[_typed(f.name, f.dataType, path) for f in base.fields])
    elif lower.endswith(".parquet"):
        df = _read(spark.read.parquet, path)
    else:
        raise ValueError(f"unsupported submissions file {path!r}; expected one of {SUBMISSION_SUFFIXES}")
    if check_empty and df.isEmpty():
        raise ValueError(f"submissions file {path!r} has no rows")
    return df


def parse_cutoff(since: str | None) -> date | None:
    """P7 parameter check: an ISO day, or nothing for no cut-off."""
    if since is None or since == "":
        return None
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", since):
        raise ValueError(f"cut-off {since!r} is not a day like 2024-01-31")
    return date.fromisoformat(since)


def updated_since(df: DataFrame, since: str | None, column: str = "updated_at", inclusive: bool = False) -> DataFrame:
    """Rows updated strictly after the cut-off date (D-20), or at/after with
    ``inclusive``; no cut-off keeps all rows."""
    cutoff = parse_cutoff(since)
    if cutoff is None:
        return df
    bound = F.lit(cutoff).cast("timestamp_ntz") if df.schema[column].dataType.simpleString() == "timestamp_ntz" else F.to_timestamp(F.lit(cutoff))
    c = F.col(column)
    return df.where(c >= bound if inclusive else c > bound)


def read_form_submissions(spark: SparkSession, path: str, form_id: int | str | None = None, since: str | None = None,
                          form_col: str = "form_id", updated_col: str = "updated_at", inclusive: bool = False) -> DataFrame:
    """One form's submissions, optionally only those updated after ``since``. Both
    predicates are pushed to the Parquet scan (and prune partitions when the data is
    partitioned by form)."""
    df = _read(spark.read.parquet, path)
    if form_id is not None:
        df = df.where(F.col(form_col) == F.lit(form_id))
    return updated_since(df, since, updated_col, inclusive)


#: Types of the export's columns that are no text.
ORG_UNIT_TYPES = {"ID": LongType(), "Latitude": DoubleType(), "Longitude": DoubleType()}


def read_org_units(spark: SparkSession, path: str, type_name: str | None = None, type_col: str = "Type", types: dict[str, DataType] | None = None) -> DataFrame:
    """S3: the org-unit export (CSV with a header); ids and coordinates are numbers
    (``types``, default ``ORG_UNIT_TYPES``; a value that does not fit fails the job), the
    other columns text; optionally only one type."""
    df = read_csv_text(spark, path)
    known = ORG_UNIT_TYPES if types is None else types
    df = df.select(*[_typed(c, known.get(c, StringType()), path) for c in df.columns])
    return df.where(F.col(type_col) == F.lit(type_name)) if type_name is not None else df


def read_form_metadata(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Metadata documents, one row per form version (``METADATA_SCHEMA``)."""
    reader = spark.read.schema(METADATA_SCHEMA)
    return _read(reader.json if fmt == "json" else reader.parquet, path)


def read_form_definitions(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """The questions or choices sheet of all versions of a form definition; text
    trimmed."""
    if kind not in ("questions", "choices"):
        raise ValueError("kind must be 'questions' or 'choices'")
    sheet = f"{path.rstrip('/')}/{kind}"
    return strip_strings(read_csv_text(spark, sheet) if fmt == "csv" else _read(spark.read.parquet, sheet))


def read_form_definition(spark: SparkSession, path: str, kind: str, version: str | None = None, fmt: str = "parquet",
                         version_col: str = "form_version") -> DataFrame:
    """The questions or choices sheet of a form definition, for one version or the
    latest (highest integer) version; all-null rows dropped, text trimmed."""
    df = read_form_definitions(spark, path, kind, fmt)
    if version is not None:
        df = df.where(F.col(version_col) == F.lit(version))
    elif version_col in df.columns:
        df = latest_version(df.withColumn("__definition", F.lit(1)), "__definition", version_col).drop("__definition")
    return df.na.drop("all", subset=[c for c in df.columns if c != version_col])


def read_geometries(spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "id", geometry_col: str = "geometry") -> DataFrame:
    """(id, GeoJSON text) lookup."""
    reader = spark.read
    df = _read(reader.json if fmt == "json" else reader.parquet, path)
    return df.select(F.col(id_col).alias("id"), F.col(geometry_col).cast("string").alias("geometry"))
