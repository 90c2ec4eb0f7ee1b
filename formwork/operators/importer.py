"""Import routing: create/update split (P8), outboxes for create (K4), update (K5) and
delete (K6), the strategy switch (K7), lock lookup (J6), outcome summary (A3) and the
union of outcomes (U2).

The reference sends one to four HTTP requests per row from a Python loop. Here every
row's fate is decided by one projection (a ``when`` chain giving ``outcome`` and
``reason``) and the documents and request bodies are written as columns of an outbox
table; delivering them is left to a consumer of that table. Identifiers are derived
from row content, so a retried task produces the same rows.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formwork.functions.coerce import bad_number, coerce_int, text_to_number
from formwork.functions.documents import (
    create_payload,
    enrich_submission,
    instance_uuid,
    render_submission,
    row_key,
    strip_uuid,
    update_payload,
)
from formwork.operators.columns import q, question_fields
from formwork.operators.lookup import fits_broadcast, hot_keys, left_lookup
from formwork.operators.validate import Rules, row_validity, validate_rows, validate_rows_by_version

IMPORTED, UPDATED, DELETED, IGNORED, UNROUTED = "imported", "updated", "deleted", "ignored", "unrouted"
#: Columns that must hold numbers where they are not blank.
NUMBERS = ("accuracy", "altitude", "latitude", "longitude")
OUTCOMES = (IMPORTED, UPDATED, IGNORED, DELETED, UNROUTED)
OUTBOX_TYPES = {
    "outcome": "string",
    "reason": "string",
    "instance_id": "bigint",
    "instance_uuid": "string",
    "document": "string",
    "payload": "string",
    "patch_org_unit": "boolean",
}


def route(df: DataFrame) -> Column:
    """P8 as a column: create = no ``id`` and an org unit; update = an ``id``; other
    rows are ``unrouted`` (D-10: reported, not silently lost)."""
    has_id = q("id").isNotNull() if "id" in df.columns else F.lit(False)
    has_ou = q("org_unit_id").isNotNull() if "org_unit_id" in df.columns else F.lit(False)
    return F.when(~has_id & has_ou, F.lit("create")).when(has_id, F.lit("update")).otherwise(F.lit(UNROUTED))


def split_create_update(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(create, update, unrouted) frames."""
    r = route(df)
    return df.where(r == "create"), df.where(r == "update"), df.where(r == UNROUTED)


def _truthy(c: Column, data_type=None) -> Column:
    num = text_to_number(c, "double", data_type)
    return F.coalesce(F.when(num.isNotNull(), num != 0).otherwise(c.cast("string") != ""), F.lit(False))


class _Prepared:
    """Validity, template presence and document builders for a submissions frame."""

    def __init__(self, df: DataFrame, rules: Rules | None, rules_by_version: dict[str, Rules] | None, strict: bool, latest_version_id: str, version_col: str):
        self.source_columns = list(df.columns)
        if version_col in df.columns:
            if rules_by_version is None:
                raise ValueError(f"'{version_col}' present: rules per version are needed")
            # versions whose documents have the same shape share one expression
            shapes: dict[tuple, list[str]] = {}
            for version, r in sorted(rules_by_version.items()):
                shapes.setdefault((tuple(r.names()), r.group()), []).append(version)
            marks = {v: i for i, versions in enumerate(shapes.values()) for v in versions}
            checked = validate_rows_by_version(df, rules_by_version, version_col, marks, "_v_shape")
            self.df = checked.withColumnsRenamed({"row_valid": "_v_valid", "has_template": "_v_template"})
            self.valid = F.col("_v_valid") if strict else F.lit(True)
            self.has_template = F.col("_v_template")
            self.version: Column = q(version_col).cast("string")
            self.shapes = [rules_by_version[versions[0]] for versions in shapes.values()]
        else:
            if rules is None:
                raise ValueError("rules are needed")
            summaries = {"constraints_validation_summary", "choices_validation_summary"} & set(df.columns)
            self.df = df if summaries else validate_rows(df, rules)
            self.valid = row_validity(self.df, strict)
            self.has_template = F.lit(True)
            self.version = F.lit(latest_version_id)
            self.shapes = None
        self.rules = rules

    def _per_version(self, build) -> Column:
        if self.shapes is None:
            return build(self.rules, self.version)
        out = F.lit(None).cast("string")
        for i, rules in enumerate(self.shapes):
            out = F.when(F.col("_v_shape") == i, build(rules, self.version)).otherwise(out)
        return out

    def fields(self, rules: Rules) -> list[str]:
        """Question columns in frame order, calculated ones included (they are part of
        the frame when the document is built)."""
        return question_fields(self.df, rules.names())

    def render(self, form_id, uuid: Column) -> Column:
        return self._per_version(lambda r, v: render_submission(self.df, self.fields(r), form_id, v, r.group(), uuid))

    def enrich(self, form_id, uuid: Column, instance: Column, editor, attribute: str) -> Column:
        return self._per_version(lambda r, v: enrich_submission(self.df, self.fields(r), form_id, v, r.group(), uuid, instance, editor, attribute))


def _stage(p: _Prepared, cols: dict[str, Column]) -> dict[str, Column]:
    """Add per-row values used by several output columns as columns of their own, so
    they are computed once per row (Catalyst does not inline a costly expression that
    is referenced more than once) and return references to them."""
    p.df = p.df.select("*", *[c.alias(n) for n, c in cols.items()])
    return {n: F.col(n) for n in cols}


def _create_columns(p: _Prepared, form_id: int, created_at: int, directory: str, key_cols: list[str] | None) -> dict[str, Column]:
    df = p.df
    org = coerce_int(q("org_unit_id"), df.schema["org_unit_id"].dataType) if "org_unit_id" in df.columns else F.lit(None).cast("bigint")
    # A row whose version has no rules cannot be validated: it fails on the template.
    reason = F.when(~p.has_template, F.lit("no_template")).when(~p.valid, F.lit("invalid")).when(org.isNull(), F.lit("bad_org_unit")).when(bad_number(df, NUMBERS), F.lit("bad_number"))
    key = row_key(df, key_cols or p.source_columns)
    if key_cols is None:
        # equal rows of a run are told apart by the part of the input that holds them and a
        # number within it, so no task sees them all; runs are told apart by their time
        part = _stage(p, {"_c_part": F.spark_partition_id()})["_c_part"]
        same = F.xxhash64(*[q(c) for c in p.source_columns])
        number = F.row_number().over(Window.partitionBy(part, same, key).orderBy(F.lit(1)))
        key = F.concat_ws("#", key, part, number, F.lit(created_at))
    staged = _stage(p, {"_c_uuid": instance_uuid(key), "_c_reason": reason})
    uuid, reason = staged["_c_uuid"], staged["_c_reason"]
    ok = reason.isNull()
    return {
        "outcome": F.when(ok, F.lit(IMPORTED)).otherwise(F.lit(IGNORED)),
        "reason": reason,
        "instance_id": F.lit(None).cast("bigint"),
        "instance_uuid": F.when(ok, uuid),
        "document": F.when(ok, p.render(form_id, uuid)),
        "payload": F.when(ok, create_payload(p.df, uuid, form_id, created_at, directory)),
        "patch_org_unit": F.lit(False),
    }


def _update_columns(p: _Prepared, form_id: int, editor, attribute: str, locked: Column) -> dict[str, Column]:
    df = p.df
    staged = _stage(p, {"_u_uuid": strip_uuid(df, "instanceID"), "_u_iid": coerce_int(q("id"), df.schema["id"].dataType)})
    uuid, iid = staged["_u_uuid"], staged["_u_iid"]
    reason = (
        F.when(~p.has_template, F.lit("no_template"))
        .when(~p.valid, F.lit("invalid"))
        .when(uuid.isNull(), F.lit("missing_instance_id"))
        .when(iid.isNull(), F.lit("bad_id"))
        .when(bad_number(df, NUMBERS), F.lit("bad_number"))
        .when(locked, F.lit("locked"))
    )
    has_ou = _truthy(q("org_unit_id"), df.schema["org_unit_id"].dataType) if "org_unit_id" in df.columns else F.lit(False)
    reason = _stage(p, {"_u_reason": reason})["_u_reason"]
    ok = reason.isNull()
    return {
        "outcome": F.when(ok, F.lit(UPDATED)).otherwise(F.lit(IGNORED)),
        "reason": reason,
        "instance_id": iid,
        "instance_uuid": F.when(ok, uuid),
        "document": F.when(ok, p.enrich(form_id, uuid, iid, editor, attribute)),
        "payload": F.when(ok & has_ou, update_payload(p.df, form_id)),
        "patch_org_unit": ok & has_ou,
    }


def _locks(df: DataFrame, instances: DataFrame | None) -> tuple[DataFrame, Column]:
    """Left lookup of each row's lock flag; no flag counts as unlocked. The lock
    table is reduced to one row per id first, so the join cannot fan out; rows without
    an integer id (every create row of a combined import) are spread, not piled on the
    null key (``left_lookup``)."""
    if instances is None:
        return df, F.lit(False)
    locks = instances.groupBy(F.col("id").cast("bigint").alias("_lock_id")).agg(
        F.bool_or(F.coalesce(F.col("is_locked"), F.lit(False))).alias("_locked")
    )
    key = coerce_int(q("id"), df.schema["id"].dataType)
    hot = [] if df.isStreaming or fits_broadcast(instances.select("id", "is_locked")) else hot_keys(df, key)
    joined = left_lookup(df, key, locks, "_lock_id", hot=hot)
    return joined, F.coalesce(F.col("_locked"), F.lit(False))


def _select(df: DataFrame, keep: list[str], cols: dict[str, Column], route_col: Column | None = None) -> DataFrame:
    extra = [route_col.alias("route")] if route_col is not None else []
    return df.select(*[q(k) for k in keep], *extra, *[c.alias(n) for n, c in cols.items()])


def _require(df: DataFrame, cols: list[str], mode: str) -> None:
    for c in cols:
        if c not in df.columns:
            raise RuntimeError(f"{mode} mode requires a '{c}' column")


def create_outbox(df: DataFrame, rules: Rules | None, form_id: int, *, rules_by_version: dict[str, Rules] | None = None, strict: bool = True,
                  latest_version_id: str = "", created_at: int | None = None, directory: str = "creates",
                  key_cols: list[str] | None = None, keep: list[str] | None = None, version_col: str = "form_version") -> DataFrame:
    """K4: one outbox row per submission: ``imported`` with its document and creation
    body, or ``ignored`` with the first failing reason (validity, template, org unit).
    ``created_at`` (epoch seconds) is fixed per run so retries agree. Instance ids are
    derived from ``key_cols`` (which must tell rows apart), else from the run, the whole
    row and its number among equal rows."""
    p = _Prepared(df, rules, rules_by_version, strict, latest_version_id, version_col)
    cols = _create_columns(p, form_id, int(created_at if created_at is not None else time.time()), directory, key_cols)
    return _select(p.df, keep or [], cols)


def update_outbox(df: DataFrame, rules: Rules | None, form_id: int, *, instances: DataFrame | None = None, editor: int | None = None,
                  instance_attribute: str = "instance", rules_by_version: dict[str, Rules] | None = None, strict: bool = True,
                  latest_version_id: str = "", keep: list[str] | None = None, version_col: str = "form_version") -> DataFrame:
    """K5: ``updated`` rows carry the enriched document and, when the row has an org
    unit, the patch body; the lock is checked before the patch is planned (D-9)."""
    _require(df, ["id", "instanceID"], "UPDATE")
    p = _Prepared(df, rules, rules_by_version, strict, latest_version_id, version_col)
    p.df, locked = _locks(p.df, instances)
    cols = _update_columns(p, form_id, editor, instance_attribute, locked)
    return _select(p.df, keep or [], cols)


def delete_outbox(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """K6: ``deleted`` with the integer instance id, or ``ignored`` for a missing or
    non-integer id."""
    _require(df, ["id"], "DELETE")
    iid = coerce_int(q("id"), df.schema["id"].dataType)
    reason = F.when(q("id").isNull(), F.lit("missing_id")).when(iid.isNull(), F.lit("bad_id"))
    return df.select(
        *[q(k) for k in keep or []],
        F.when(reason.isNull(), F.lit(DELETED)).otherwise(F.lit(IGNORED)).alias("outcome"),
        reason.alias("reason"),
        iid.alias("instance_id"),
    )


def route_import(df: DataFrame, strategy: str, rules: Rules | None, form_id: int, *, instances: DataFrame | None = None,
                 editor: int | None = None, instance_attribute: str = "instance", rules_by_version: dict[str, Rules] | None = None,
                 strict: bool = True, latest_version_id: str = "", created_at: int | None = None, directory: str = "creates",
                 key_cols: list[str] | None = None, keep: list[str] | None = None, version_col: str = "form_version") -> DataFrame:
    """K7: the strategy switch. CREATE_AND_UPDATE routes every row (P8) and decides
    create and update outcomes in the same projection: one scan, one lock join."""
    if strategy == "DELETE":
        return delete_outbox(df, keep)
    if strategy == "CREATE":
        return create_outbox(df, rules, form_id, rules_by_version=rules_by_version, strict=strict, latest_version_id=latest_version_id,
                             created_at=created_at, directory=directory, key_cols=key_cols, keep=keep, version_col=version_col)
    if strategy == "UPDATE":
        return update_outbox(df, rules, form_id, instances=instances, editor=editor, instance_attribute=instance_attribute,
                             rules_by_version=rules_by_version, strict=strict, latest_version_id=latest_version_id, keep=keep, version_col=version_col)
    if strategy != "CREATE_AND_UPDATE":
        raise ValueError(f"unknown import strategy {strategy!r}")
    p = _Prepared(df, rules, rules_by_version, strict, latest_version_id, version_col)
    p.df = p.df.select("*", route(df).alias("_route"))
    r = F.col("_route")
    p.df, locked = _locks(p.df, instances) if "id" in df.columns else (p.df, F.lit(False))
    stamp = int(created_at if created_at is not None else time.time())
    create = _create_columns(p, form_id, stamp, directory, key_cols)
    update = _update_columns(p, form_id, editor, instance_attribute, locked) if "instanceID" in df.columns and "id" in df.columns else None
    if update is None:  # no instanceID column: update rows cannot be matched
        update = {n: F.lit(None).cast(t) for n, t in OUTBOX_TYPES.items()}
        update.update(outcome=F.lit(IGNORED), reason=F.lit("missing_instance_id"), patch_org_unit=F.lit(False))
    unrouted = {n: F.lit(None).cast(t) for n, t in OUTBOX_TYPES.items()}
    unrouted.update(outcome=F.lit(UNROUTED), patch_org_unit=F.lit(False))
    cols = {n: F.when(r == "create", create[n]).when(r == "update", update[n]).otherwise(unrouted[n]) for n in OUTBOX_TYPES}
    return _select(p.df, keep or [], cols, r)


def outcome_summary(outbox: DataFrame) -> DataFrame:
    """A3: one row of counts per outcome, in one aggregate pass."""
    return outbox.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])


def combine_outcomes(*parts: DataFrame) -> DataFrame:
    """Union of outboxes by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

