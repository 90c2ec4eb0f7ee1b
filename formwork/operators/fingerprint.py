"""Content fingerprint (A7) and counts (A5).

The reference hashes the bytes of the written file. A distributed write has no single
byte stream and its part files depend on partitioning, so the fingerprint is taken over
row content instead: the row count plus the sums of two independent 64-bit row hashes.
Sums do not depend on row order or partitioning, and the aggregate combines map-side,
so the cost is one scan whatever the skew. Every value is hashed with a mark for null,
nested values as JSON text with their nulls, and the text ends in a hash of the column
names and types, so a value that moves to another column, a renamed or retyped column
and regrouped lists all change it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

from formwork.operators.columns import q


#: Nested values as JSON: nulls kept, times to the microsecond (the default stops at
#: milliseconds).
JSON_FORM = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _hashable(field: StructField) -> list[Column]:
    """A null mark and the value; lists, maps and structs as JSON (hashes skip nulls and
    the borders of lists)."""
    value = q(field.name)
    if isinstance(field.dataType, (ArrayType, MapType, StructType)):
        return [value.isNull(), F.to_json(F.struct(value.alias("v")), JSON_FORM)]
    return [value.isNull(), value]


def schema_mark(df: DataFrame) -> str:
    """Hash of the column names and types, in name order."""
    shape = "\n".join(f"{f.name}\t{f.dataType.simpleString()}" for f in sorted(df.schema.fields, key=lambda f: f.name))
    return hashlib.md5(shape.encode()).hexdigest()


def fingerprint_columns(df: DataFrame) -> list:
    cols = [c for f in sorted(df.schema.fields, key=lambda f: f.name) for c in _hashable(f)]
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("xxhash_sum"),
        F.coalesce(F.sum(F.hash(*cols).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("murmur_sum"),
    ]


def content_fingerprint(df: DataFrame) -> tuple[int, str]:
    """(rows, fingerprint text); equal content gives equal values whatever the row
    order or partitioning. Columns are taken in name order."""
    return fingerprint_of(df, df.agg(*fingerprint_columns(df)).collect()[0].asDict())


def fingerprint_of(df: DataFrame, sums: dict) -> tuple[int, str]:
    """(rows, fingerprint text) from the values of ``fingerprint_columns``, computed by an
    aggregate or observed while ``df`` was written."""
    return int(sums["rows"]), f"{sums['rows']}:{sums['xxhash_sum']}:{sums['murmur_sum']}:{schema_mark(df)}"


def row_count(df: DataFrame) -> int:
    """A5."""
    return df.count()


def is_empty(df: DataFrame) -> bool:
    """A5: stops at the first row found."""
    return df.isEmpty()
