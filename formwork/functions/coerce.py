"""Type coercions: date parsing (F2), number coercion (F13), expected-type casts (F15),
flat-file flattening (F17) and null blanking (P11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    MapType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Source formats of the org-unit export.
DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm"


def _c(c: Column | str) -> Column:
    return F.col("`" + c + "`") if isinstance(c, str) else c


def parse_dates(c: Column | str, kind: str = "date", strict: bool = True) -> Column:
    """``yyyy-MM-dd`` to date or ``yyyy-MM-dd HH:mm`` to a zone-less timestamp.

    Strict parsing raises on bad text (ANSI); lenient parsing gives null."""
    col = _c(c)
    if kind == "date":
        return F.to_date(col, DATE_FORMAT) if strict else F.try_to_timestamp(col, F.lit(DATE_FORMAT)).cast("date")
    if kind == "datetime":
        if strict:
            return F.to_timestamp_ntz(col, F.lit(DATETIME_FORMAT))
        return F.try_to_timestamp(col, F.lit(DATETIME_FORMAT)).cast("timestamp_ntz")
    raise ValueError(f"kind must be 'date' or 'datetime', not {kind!r}")


# Text that a number cast can accept. Casting other text under ANSI makes the JVM throw
# and catch an exception per row, which is far slower than a regex test; so text is
# tested first and only candidates are cast (the cast still decides, e.g. on overflow).
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i:inf|infinity|nan)\s*$"


def text_to_number(c: Column, to: str, data_type=None) -> Column:
    """``try_cast`` that tests text first (see ``INT_TEXT``); non-text goes straight to
    ``try_cast``. ``data_type`` is the column's Spark type when known."""
    if data_type is not None and not isinstance(data_type, StringType):
        return c.try_cast(to)
    pattern = INT_TEXT if to in ("bigint", "int", "long", "integer") else FLOAT_TEXT
    return F.when(c.rlike(pattern), c.try_cast(to))


def coerce_int(c: Column | str, data_type=None) -> Column:
    """integer value like Python ``int(x)``: ``' 12 '`` -> 12, ``'12.7'`` -> null,
    12.7 -> 12; anything else null."""
    return text_to_number(_c(c), "bigint", data_type)


def number_or_zero(df: DataFrame, name: str, absent: float | None = 0.0) -> Column:
    """``float(x or 0)`` when the column exists, else ``absent`` (0 or null)."""
    if name in df.columns:
        return F.coalesce(text_to_number(_c(name), "double", df.schema[name].dataType), F.lit(0.0))
    if absent is None:
        return F.lit(None).cast("double")
    return F.lit(absent)


def bad_number(df: DataFrame, names: tuple[str, ...]) -> Column:
    """some of the named columns holds text that is neither blank nor a number."""
    out = F.lit(False)
    for name in names:
        if name in df.columns and isinstance(df.schema[name].dataType, StringType):
            text = _c(name)
            out = out | F.coalesce((F.trim(text) != "") & text_to_number(text, "double").isNull(), F.lit(False))
    return out


def blank_nulls(cols: list[str]) -> list[Column]:
    """Text of each column with null as the empty string."""
    return [F.coalesce(_c(c).cast("string"), F.lit("")).alias(c) for c in cols]


# Type names of the validation rules and their Spark types.
TYPE_NAMES = {
    "String": "string",
    "Int64": "bigint",
    "Float64": "double",
    "Boolean": "boolean",
    "Date": "date",
    "Datetime": "timestamp_ntz",
}


def cast_expected(df: DataFrame, invalid_types: dict[str, tuple[str, str]]) -> DataFrame:
    """cast each wrongly typed column to its expected type in one projection.

    Under ANSI a value that cannot be cast raises. Columns whose expectation is a choice
    of types (e.g. "Date or Datetime or String") are reported only, not cast (D-8)."""
    targets = {c: TYPE_NAMES[e] for c, (e, _) in invalid_types.items() if e in TYPE_NAMES}
    if not targets:
        return df
    return df.select(*[_c(c).cast(targets[c]).alias(c) if c in targets else _c(c) for c in df.columns])


def flatten_for_text(df: DataFrame) -> DataFrame:
    """before a flat-file export, temporal -> text, boolean -> 0/1,
    arrays/maps/structs -> JSON text; one projection."""
    out = []
    for f in df.schema.fields:
        c = _c(f.name)
        t = f.dataType
        if isinstance(t, (DateType, TimestampType, TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, BooleanType):
            c = c.cast("int")
        elif isinstance(t, (ArrayType, MapType, StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)
