"""Submission documents and request bodies as column expressions: the XML document of a
new submission (F9), the enriched document of an edit (F10), instance identifiers (F11)
and JSON bodies (F14).

Documents are assembled with ``concat`` over escaped column text, so rendering stays in
whole-stage code generation. Nothing is parsed back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

from formwork.functions.coerce import coerce_int, number_or_zero

# The submission document layout (OpenRosa namespaces, indentation).
NS_DECL = 'xmlns:jr="http://openrosa.org/javarosa" xmlns:orx="http://openrosa.org/xforms"'
XML_DECL = '<?xml version="1.0" encoding="utf-8"?>'
ROOT_OPEN = "<data " + NS_DECL
ATTR_INDENT = "      "
GROUP_INDENT = "    "
FIELD_INDENT = "        "
META_OPEN = "    <meta>"
INSTANCE_LINE = "        <instanceID>uuid:"
INSTANCE_CLOSE = "</instanceID>"
META_CLOSE = "</meta>"
ROOT_CLOSE = "</data>"


def _c(c: Column | str) -> Column:
    return F.col("`" + c + "`") if isinstance(c, str) else c


def xml_text(c: Column) -> Column:
    """Escape ``& < >`` for element text (D-11: values are escaped)."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def xml_attr(c: Column) -> Column:
    """Escape for a double-quoted attribute value."""
    return F.replace(xml_text(c), F.lit('"'), F.lit("&quot;"))


def _python_layout(text: Column) -> Column:
    """Python's layout of a number given as ``d.ddde±x`` text."""
    parts = r"^(-?)([0-9])(?:\.([0-9]+))?e([+-][0-9]+)$"
    sign, lead = F.regexp_extract(text, parts, 1), F.regexp_extract(text, parts, 2)
    frac = F.regexp_replace(F.regexp_extract(text, parts, 3), "0+$", "")
    exp = F.regexp_extract(text, parts, 4).try_cast("int")
    digits = F.concat(lead, frac)
    n_int = exp + 1
    fixed = F.when(
        F.length(digits) <= n_int, F.concat(sign, F.rpad(digits, n_int, "0"), F.lit(".0"))
    ).otherwise(F.concat(sign, F.substring(digits, F.lit(1), n_int), F.lit("."), F.substring(digits, n_int + 1, F.length(digits))))
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    magnitude = F.abs(exp).cast("string")
    sci = F.concat(sign, lead, F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)), F.lit("e"),
                   F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.length(magnitude) < 2, F.concat(F.lit("0"), magnitude)).otherwise(magnitude))
    return F.when(exp.between(0, 15), fixed).when(exp.between(-4, -1), small).otherwise(sci)


def python_float_text(c: Column) -> Column:
    """A double as Python prints it (``repr``): the shortest text that reads back as
    the same double, in fixed notation from 1e-4 up to 1e16 and as ``1.5e-07`` /
    ``1e+16`` otherwise; ``nan``, ``inf``, ``-inf``.

    The digits come from formatting with 1, 2, ... 17 significant digits and keeping
    the first that reads back exactly, i.e. the shortest (the JVM's own double-to-text
    is not always the shortest before JDK 19). Higher-order functions bind each intermediate
    text once, so the expression stays small however often it is used.

    Fast path: from 1e-3 up to 1e7 Spark's own text is already fixed notation, and
    with at most 15 digits it is the shortest one, so typical answers (4.4, 12.75)
    skip the formatting."""
    plain = c.cast("string")
    fast = (c == 0) | ((F.abs(c) >= 1e-3) & (F.abs(c) < 1e7) & (F.length(F.regexp_replace(plain, "[^0-9]", "")) <= 15))
    candidates = F.array(*[F.format_string(f"%.{p}e", c) for p in range(17)])
    exact = F.filter(candidates, lambda t: t.cast("double") == c)
    chosen = F.coalesce(F.try_element_at(exact, F.lit(1)), F.try_element_at(candidates, F.lit(17)))
    laid_out = F.try_element_at(F.transform(F.array(chosen), _python_layout), F.lit(1))
    return F.when(fast, plain).when(F.isnan(c), F.lit("nan")).when(c == float("inf"), F.lit("inf")).when(
        c == float("-inf"), F.lit("-inf")).otherwise(laid_out)


def value_text(data_type, name: str) -> Column:
    """Text of a field of type ``data_type`` as Python would print it; null is the
    empty string."""
    c = _c(name)
    if isinstance(data_type, BooleanType):
        c = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif isinstance(data_type, (DoubleType, FloatType)):
        c = python_float_text(c.cast("double"))
    elif isinstance(data_type, (TimestampType, TimestampNTZType)):
        # Python prints microseconds as six digits when there are any.
        c = F.regexp_replace(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
    elif isinstance(data_type, ArrayType) and isinstance(data_type.elementType, StringType):
        quoted = F.transform(c, lambda x: F.when(x.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), x, F.lit("'"))))
        c = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    elif not isinstance(data_type, StringType):
        c = c.cast("string")
    return F.coalesce(c, F.lit(""))


def _types(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def _as_col(v: Column | str | int | None) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit("" if v is None else str(v))


def render_submission(
    df: DataFrame,
    fields: list[str],
    form_id: str | int,
    version: Column | str,
    group: str | None,
    uuid: Column,
) -> Column:
    """the document of a new submission, one line per part, joined by newlines.

    ``fields`` are the question columns in submission order (P10); ``group`` is the
    first "begin group" question, or None.
    """
    parts: list[Column] = [
        F.lit(ROOT_OPEN + "\n" + ATTR_INDENT + 'id="'),
        xml_attr(_as_col(form_id)),
        F.lit('" version="'),
        xml_attr(_as_col(version)),
        F.lit('">\n' + (f"{GROUP_INDENT}<{group}>" if group else "") + "\n"),
    ]
    types = _types(df)
    for name in fields:
        parts += [F.lit(f"{FIELD_INDENT}<{name}>"), xml_text(value_text(types[name], name)), F.lit(f"</{name}>\n")]
    parts += [
        F.lit((f"{GROUP_INDENT}</{group}>" if group else "") + "\n" + META_OPEN + "\n" + INSTANCE_LINE),
        xml_text(uuid),
        F.lit(INSTANCE_CLOSE + "\n    " + META_CLOSE + "\n" + ROOT_CLOSE),
    ]
    return F.concat(*parts)


def enrich_submission(
    df: DataFrame,
    fields: list[str],
    form_id: str | int,
    version: Column | str,
    group: str | None,
    uuid: Column,
    instance: Column,
    editor: int | Column | None,
    instance_attribute: str,
) -> Column:
    """the document of an edit, as the server expects it after enrichment: XML
    declaration, both namespace declarations first on the root, the instance id as the
    root attribute ``instance_attribute``, ``editUserID`` as the last element of
    ``meta`` when an editor is given, and empty elements in short form (``<f />``)."""
    parts: list[Column] = [
        F.lit(XML_DECL + "\n" + ROOT_OPEN + ' id="'),
        xml_attr(_as_col(form_id)),
        F.lit('" version="'),
        xml_attr(_as_col(version)),
        F.lit(f'" {instance_attribute}="'),
        xml_attr(instance.cast("string")),
        F.lit('">\n' + (f"{GROUP_INDENT}<{group}>" if group else "") + "\n"),
    ]
    types = _types(df)
    for name in fields:
        text = xml_text(value_text(types[name], name))
        parts.append(
            F.when(text == "", F.lit(f"{FIELD_INDENT}<{name} />\n")).otherwise(
                F.concat(F.lit(f"{FIELD_INDENT}<{name}>"), text, F.lit(f"</{name}>\n"))
            )
        )
    parts += [
        F.lit((f"{GROUP_INDENT}</{group}>" if group else "") + "\n" + META_OPEN + "\n" + INSTANCE_LINE),
        xml_text(uuid),
        F.lit(INSTANCE_CLOSE + "\n    "),
    ]
    if editor is not None:
        parts += [F.lit("<editUserID>"), xml_text(_as_col(editor)), F.lit("</editUserID>")]
    parts.append(F.lit(META_CLOSE + "\n" + ROOT_CLOSE))
    return F.concat(*parts)


def instance_uuid(key: Column) -> Column:
    """identifier of a new instance derived from a row key (md5 in UUID layout).

    Derived, not random, so a retried task writes the same outbox rows."""
    h = F.md5(key.cast("string"))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def row_key(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A row key for ``instance_uuid``: JSON text of the given (default: all) columns."""
    return F.to_json(F.struct(*[_c(c) for c in (columns or df.columns)]))


def strip_uuid(df: DataFrame, name: str = "instanceID") -> Column:
    """drop a leading ``uuid:``; a non-text column gives null (row ignored)."""
    if name not in df.columns or not isinstance(df.schema[name].dataType, StringType):
        return F.lit(None).cast("string")
    return F.regexp_replace(_c(name), "^uuid:", "")


def create_payload(df: DataFrame, uuid: Column, form_id: int, created_at: int, directory: str) -> Column:
    """body of an instance creation; key order as the server documents it."""
    file_name = F.concat(uuid, F.lit(".xml"))
    return F.to_json(
        F.struct(
            uuid.alias("id"),
            (coerce_int(_c("org_unit_id"), df.schema["org_unit_id"].dataType) if "org_unit_id" in df.columns
             else F.lit(None).cast("bigint")).alias("orgUnitId"),
            F.lit(int(created_at)).cast("bigint").alias("created_at"),
            F.lit(int(form_id)).alias("formId"),
            number_or_zero(df, "accuracy", 0).alias("accuracy"),
            number_or_zero(df, "altitude", 0).alias("altitude"),
            number_or_zero(df, "latitude", None).alias("latitude"),
            number_or_zero(df, "longitude", None).alias("longitude"),
            F.concat(F.lit(directory.rstrip("/") + "/"), file_name).alias("file"),
            file_name.alias("name"),
        ),
        {"ignoreNullFields": "false"},
    )


def update_payload(df: DataFrame, form_id: int) -> Column:
    """body of the org-unit patch sent with an edit."""
    return F.to_json(
        F.struct(
            _c("org_unit_id").cast("string").alias("org_unit"),
            F.lit(int(form_id)).alias("formID"),
            number_or_zero(df, "accuracy", 0).alias("accuracy"),
            number_or_zero(df, "altitude", 0).alias("altitude"),
            number_or_zero(df, "latitude", None).alias("latitude"),
            number_or_zero(df, "longitude", None).alias("longitude"),
        ),
        {"ignoreNullFields": "false"},
    )
