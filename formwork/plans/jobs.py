"""The four jobs of the reference as compositions of the operators:
submissions extract, org-unit extract, form-metadata extract and submissions import.

Each returns the frame it produced (lazy where possible) and performs the requested
sinks. Parameters that the reference fetched over HTTP (form names, definitions, lock
states) are arguments or tables here.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formwork.functions.coerce import cast_expected
from formwork.functions.text import output_name
from formwork.operators.columns import canonical_columns, canonical_sort, clean_column_names, geo_sort, sort_by_label
from formwork.operators.forms import explode_choices, latest_document, questions_from_map, questions_with_choices, replace_labels
from formwork.operators.geo import decode_geometries
from formwork.operators.importer import outcome_summary, route_import
from formwork.operators.onehot import flatten_submissions
from formwork.operators.orgunits import attach_geometry, filter_org_unit_type, org_unit_type_name, project_org_units
from formwork.operators.validate import Rules, check_table_schema, list_column, rules_from_rows, select_rules, validate_rows, validate_structure
from formwork.sinks.writers import snapshot_if_changed, write_file, write_geojson_lines, write_table
from formwork.sources.readers import read_form_definition, read_form_definitions, read_form_metadata, read_form_submissions, read_org_units, read_submissions


@dataclass
class Sinks:
    """Where a job writes: a file (K1), a table (K2) and/or a versioned snapshot (K3).

    The file goes to ``path``; or, with ``directory``, to the caller's ``name`` there,
    else to the job's default name (F16)."""

    path: str | None = None
    fmt: str = "parquet"
    table: str | None = None
    mode: str = "replace"
    snapshot_root: str | None = None
    directory: str | None = None
    name: str | None = None

    def file_path(self, base: str, prefix: str = "") -> str | None:
        if self.path:
            return self.path
        if self.directory:
            return output_name(base, "." + self.fmt, self.directory, custom=self.name, prefix=prefix)
        return None


def _publish(spark: SparkSession, df: DataFrame, sinks: Sinks | None, check_schema: bool = False,
             base: str = "", prefix: str = "") -> str | None:
    if sinks is None:
        return None
    path = sinks.file_path(base, prefix)
    if path:
        write_file(df, path, sinks.fmt)
    if sinks.table:
        if check_schema:
            check_table_schema(spark, df, sinks.table)
        write_table(spark, df, sinks.table, sinks.mode)
    if sinks.snapshot_root:
        version, _ = snapshot_if_changed(spark, df, sinks.snapshot_root, sinks.fmt)
        return version
    return None


def extract_submissions(
    spark: SparkSession,
    source: str,
    *,
    form_id: int | str | None = None,
    since: str | None = None,
    choices: DataFrame | None = None,
    language: str = "French",
    updated_col: str = "updated_at",
    sort: bool = True,
    sinks: Sinks | None = None,
    form_name: str = "submissions",
) -> DataFrame:
    """§3.1: S2 (+P7 pushed down) -> J3 when ``choices`` is given -> P4 -> F3 + P5 +
    P3 (+O1 when ``sort``) -> K1/K2 (after V5)/K3."""
    subs = read_form_submissions(spark, source, form_id=form_id, since=since, updated_col=updated_col)
    if choices is not None:
        subs = replace_labels(subs, choices, language=language)
    out = flatten_submissions(clean_column_names(subs), sort=sort)
    _publish(spark, out, sinks, check_schema=True, base=form_name)
    return out


def extract_org_units(
    spark: SparkSession,
    export_path: str,
    *,
    geometries: DataFrame | None = None,
    types: DataFrame | None = None,
    type_id: int | None = None,
    geo_path: str | None = None,
    sort: bool = True,
    sinks: Sinks | None = None,
) -> DataFrame:
    """§3.2: S3 -> P6 -> P1 + P2 + F2 -> J2 -> P3 (+O1) -> K1/K2/K3, and K8 GeoJSON
    lines when ``geo_path`` is given."""
    raw = read_org_units(spark, export_path)
    units = project_org_units(raw)
    type_name = None
    if type_id is not None:
        if types is None:
            raise ValueError("a type table is needed to filter by type id")
        type_name = org_unit_type_name(types, type_id)  # D-19: names the default file too
        units = filter_org_unit_type(units, types, type_id)
    if geometries is not None:
        units = attach_geometry(units, geometries)
    out = canonical_columns(units)
    out = canonical_sort(out, list(units.columns)) if sort else out
    if geo_path:
        geo = decode_geometries(canonical_columns(units)) if "geometry" in units.columns else canonical_columns(units)
        geo = geo_sort(geo) if sort else geo
        write_geojson_lines(geo, geo_path)
    _publish(spark, out, sinks, base=type_name or "", prefix="ou_" if type_name else "orgunits")
    return out


def extract_form_metadata(
    spark: SparkSession,
    metadata_path: str,
    *,
    form_id: str | None = None,
    fmt: str = "json",
    sinks: Sinks | None = None,
    form_name: str = "form",
) -> DataFrame:
    """§3.4: S4 -> A1 -> F19 + F18 -> J1 -> O2 -> K1/K2/K3."""
    meta = read_form_metadata(spark, metadata_path, fmt)
    if form_id is not None:
        meta = meta.where(F.col("form_id") == F.lit(str(form_id)))
    if meta.isEmpty():  # D-22: a clear error instead of an empty sheet
        raise ValueError(f"no form metadata found in {metadata_path!r}" + (f" for form {form_id}" if form_id is not None else ""))
    latest = latest_document(meta, "form_id", "version")
    sheet = sort_by_label(questions_with_choices(latest))
    _publish(spark, sheet, sinks, base=form_name, prefix="md_")
    return sheet


def extract_metadata_sheets(spark: SparkSession, metadata_path: str, *, form_id: str | None = None, fmt: str = "json",
                            form_name: str = "form", questions_sinks: Sinks | None = None, choices_sinks: Sinks | None = None) -> tuple[DataFrame, DataFrame]:
    """§3.4, the two sheets on their own: S4 -> A1 -> F19 and F18 -> K1/K2/K3 each."""
    meta = read_form_metadata(spark, metadata_path, fmt)
    if form_id is not None:
        meta = meta.where(F.col("form_id") == F.lit(str(form_id)))
    latest = latest_document(meta, "form_id", "version")
    questions, choices = questions_from_map(latest), explode_choices(latest)
    _publish(spark, questions, questions_sinks, base=f"{form_name}_questions", prefix="md_")
    _publish(spark, choices, choices_sinks, base=f"{form_name}_choices", prefix="md_")
    return questions, choices


def definition_rules(spark: SparkSession, definition_path: str, version: str | None = None, fmt: str = "parquet") -> Rules:
    """S5 + P9: the rules of one version (default: the latest) of a stored definition."""
    questions = read_form_definition(spark, definition_path, "questions", version, fmt)
    try:
        choices = read_form_definition(spark, definition_path, "choices", version, fmt)
    except FileNotFoundError:
        choices = None
    return select_rules(questions, choices)


def rules_per_version(spark: SparkSession, submissions: DataFrame, definition_path: str, fmt: str = "parquet",
                      version_col: str = "form_version") -> dict[str, Rules]:
    """J5 inputs: the rules of every version present in the submissions, from one read of
    each sheet of the definition, joined to the distinct versions (an aggregate)."""
    versions = submissions.select(F.col(version_col).cast("string").alias("_version")).where("_version is not null").distinct()

    def by_version(sheet: DataFrame) -> dict[str, list[dict]]:
        out: dict[str, list[dict]] = {}
        for r in sheet.join(versions, F.col("form_version").cast("string") == F.col("_version"), "left_semi").collect():
            out.setdefault(str(r["form_version"]), []).append(r.asDict())
        return out

    try:
        sheet = read_form_definitions(spark, definition_path, "choices", fmt)
        list_col, choices = list_column(sheet.columns), by_version(sheet)
    except FileNotFoundError:
        list_col, choices = None, {}
    pairs = {v: [(r[list_col], r["label"]) for r in rows] for v, rows in choices.items()} if list_col else {}
    questions = by_version(read_form_definitions(spark, definition_path, "questions", fmt))
    # a version without a definition is absent: it has no template
    return {v: rules_from_rows(rows, pairs.get(v, []) if list_col else None) for v, rows in questions.items()}


@dataclass
class ImportResult:
    outbox: DataFrame
    summary: DataFrame
    findings: DataFrame
    structure_valid: bool


def import_submissions(
    spark: SparkSession,
    path: str,
    rules: Rules | None,
    strategy: str,
    form_id: int,
    *,
    definition_path: str | None = None,
    rules_by_version: dict[str, Rules] | None = None,
    instances: DataFrame | None = None,
    editor: int | None = None,
    instance_attribute: str = "instance",
    latest_version_id: str = "",
    strict: bool = False,
    created_at: int | None = None,
    directory: str = "creates",
    key_cols: list[str] | None = None,
    outbox_path: str | None = None,
) -> ImportResult:
    """§3.3: S1 -> V1 (strict: raise on errors) -> F15 -> V2 (no ``form_version``) ->
    K7 -> A3. Rules are given, or read from ``definition_path`` (S5 + P9): the latest
    version for the structure check, and one per distinct ``form_version`` (J5). The outbox is written partitioned by outcome when ``outbox_path`` is
    given, then the summary is read from what was written (one pass over the data)."""
    df = read_submissions(spark, path)
    if rules is None:
        if definition_path is None:
            raise ValueError("rules or a definition path are needed")
        rules = definition_rules(spark, definition_path)
        if rules_by_version is None and "form_version" in df.columns:
            rules_by_version = rules_per_version(spark, df, definition_path)
    ok, findings, invalid = validate_structure(spark, df, rules, strategy)
    if not ok and strict:
        messages = [r.message for r in findings.where(F.col("severity") == "error").collect()]
        raise ValueError("; ".join(messages))
    df = cast_expected(df, invalid)
    source_columns = list(df.columns)
    if strategy != "DELETE" and "form_version" not in df.columns:
        df = validate_rows(df, rules)
    outbox = route_import(
        df, strategy, rules, form_id, instances=instances, editor=editor, instance_attribute=instance_attribute,
        rules_by_version=rules_by_version, strict=strict, latest_version_id=latest_version_id,
        created_at=created_at if created_at is not None else int(time.time()), directory=directory, key_cols=key_cols,
        keep=source_columns,
    )
    if outbox_path:
        outbox.write.mode("overwrite").partitionBy("outcome").parquet(outbox_path)
        outbox = spark.read.parquet(outbox_path)
    return ImportResult(outbox, outcome_summary(outbox), findings, ok)
