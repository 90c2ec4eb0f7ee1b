"""Form metadata operators: latest version (A1), first available value (A6), question and
choice rows from metadata documents (F19, F18), the questions-choices join (J1) and
code-to-label replacement (J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from formwork.functions.coerce import text_to_number
from formwork.operators.columns import q
from formwork.operators.lookup import left_lookup

QUESTION_FIELDS = ("name", "type", "label", "calculate")


def latest_version(
    metadata: DataFrame,
    form_col: str = "form_id",
    version_col: str = "version",
    position_col: str | None = None,
) -> DataFrame:
    """A1: keep the rows of each form's latest version.

    The latest version is the highest integer version; when no version of a form is an
    integer, the first entry (lowest ``position_col``, else lowest version text) is
    taken (D-22: a form without rows simply has no output).

    The per-form choice is an aggregate (partial on the map side, so a form holding a
    third of all rows is combined before the shuffle) joined back on the form key;
    AQE turns the join into a broadcast once the per-form table is measured small.
    """
    if isinstance(metadata.schema[version_col].dataType, IntegralType):
        # Integer versions: a plain max, i.e. a hash aggregate with a fixed-width buffer.
        vint = q(version_col).cast("bigint")
        per_form = metadata.groupBy(q(form_col).alias("__lv_form")).agg(F.max(vint).alias("__lv_latest"), F.lit(None).alias("__lv_first"))
    else:
        vint = text_to_number(q(version_col).cast("string"), "bigint")
        order = q(position_col) if position_col else q(version_col).cast("string")
        per_form = metadata.groupBy(q(form_col).alias("__lv_form")).agg(
            F.max(vint).alias("__lv_latest"),
            F.min_by(q(version_col), order).alias("__lv_first"),
        )
    joined = metadata.join(per_form, q(form_col).eqNullSafe(F.col("__lv_form")), "inner")
    keep = F.when(F.col("__lv_latest").isNotNull(), vint == F.col("__lv_latest")).otherwise(
        q(version_col) == F.col("__lv_first")
    )
    return joined.where(keep).drop("__lv_form", "__lv_latest", "__lv_first")


def latest_document(
    metadata: DataFrame,
    form_col: str = "form_id",
    version_col: str = "version",
    position_col: str | None = None,
) -> DataFrame:
    """A1 where a version of a form is one row (metadata documents): the latest one of
    each form, by the rules of ``latest_version``, in one aggregate without a join. Of
    several rows of the latest version any one is kept."""
    version = q(version_col).cast("string")
    row = F.struct(*[q(c) for c in metadata.columns])
    picked = metadata.groupBy(q(form_col).alias("__form")).agg(
        F.max_by(row, text_to_number(version, "bigint")).alias("__latest"),
        F.min_by(row, q(position_col) if position_col else version).alias("__first"),
    )
    return picked.select(F.coalesce("__latest", "__first").alias("__row")).select(*[F.col("__row")[c].alias(c) for c in metadata.columns])


def first_available(value: Column, position: Column) -> Column:
    """A6 (aggregate): the value at the lowest position among non-empty values."""
    usable = value.isNotNull() & (value.cast("string") != "")
    return F.min_by(value, F.when(usable, position))


def questions_from_map(metadata: DataFrame, questions_col: str = "questions", keep: tuple[str, ...] = ("form_id", "version")) -> DataFrame:
    """one row per question of a metadata document (name, type, label, calculate)."""
    keys = [q(k) for k in keep if k in metadata.columns]
    qs = metadata.select(*keys, F.explode(F.map_values(q(questions_col))).alias("_q"))
    return qs.select(*keys, *[F.col("_q")[f].alias(f) for f in QUESTION_FIELDS])


def explode_choices(metadata: DataFrame, choices_col: str = "choices", keep: tuple[str, ...] = ("form_id", "version")) -> DataFrame:
    """one row per choice: list name (``name``), ``choice_value``, ``choice_label``."""
    keys = [q(k) for k in keep if k in metadata.columns]
    lists = metadata.select(*keys, F.explode(q(choices_col)).alias("name", "_list"))
    return lists.select(*keys, "name", F.explode("_list").alias("_c")).select(
        *keys, "name", F.col("_c")["name"].alias("choice_value"), F.col("_c")["label"].alias("choice_label")
    )


def questions_with_choices(metadata: DataFrame, questions_col: str = "questions", choices_col: str = "choices",
                           keep: tuple[str, ...] = ("form_id", "version")) -> DataFrame:
    """F19 + F18 + J1 on metadata documents: the choices of a question are looked up in the
    document that holds both, so no join is needed and no list can be hot."""
    keys = [q(k) for k in keep if k in metadata.columns]
    qs = metadata.select(*keys, q(choices_col).alias("_choices"), F.explode(F.map_values(q(questions_col))).alias("_q"))
    listed = qs.select(*keys, "_q", F.explode_outer(F.try_element_at("_choices", F.col("_q")["name"])).alias("_c"))
    return listed.select(*keys, *[F.col("_q")[f].alias(f) for f in QUESTION_FIELDS], F.col("_c")["name"].alias("choice_value"), F.col("_c")["label"].alias("choice_label"))


def join_questions_choices(questions: DataFrame, choices: DataFrame, on: tuple[str, ...] = ("name",)) -> DataFrame:
    """The left join of questions to choices on the list name: a question without
    choices keeps null choices, a question with n choices gives n rows.

    Written as two parts so that one list holding a large share of all choices cannot
    stall a task: the inner join (AQE may split a hot key on either side of it) and the
    questions whose key has no choice, found against the distinct choice keys (the
    partial aggregate reduces a hot list to one row before the shuffle)."""
    keys = list(on)
    matched = questions.join(choices, keys, "inner")
    choice_keys = choices.select(*keys).distinct()
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in choices.schema.fields if f.name not in keys]
    unmatched = questions.join(choice_keys, keys, "left_anti").select(*keys, *[c for c in questions.columns if c not in keys], *extra)
    return matched.unionByName(unmatched)


def _labels(choices: DataFrame, columns: list[str], language: str | None) -> DataFrame:
    """One label per column and code (of several the smallest)."""
    lists = choices
    if language is not None and "language" in choices.columns:
        lists = lists.where(F.col("language") == language)
    lists = lists.where(F.col("name").isin(columns) & F.col("choice_value").isNotNull() & F.col("choice_label").isNotNull())
    return lists.groupBy("name", F.col("choice_value").cast("string").alias("_code")).agg(F.min("choice_label").alias("_label"))


def _relabel(mapping: Column):
    def fn(e: Column) -> Column:
        return F.coalesce(F.try_element_at(mapping, e.cast("string")), e.cast("string"))

    return fn


def replace_labels(
    df: DataFrame,
    choices: DataFrame,
    columns: list[str] | None = None,
    language: str | None = "French",
    max_literal: int = 20_000,
) -> DataFrame:
    """Replace choice codes by labels in answer columns; unmatched codes are kept.

    ``choices`` has ``name`` (the question / list name), ``choice_value``,
    ``choice_label`` and optionally ``language`` (D-21: the language is a parameter).
    Of several labels of a code the smallest is taken; columns without labels keep their
    type. The rows are the same by either plan: up to ``max_literal`` labels become
    literal maps in the projection, beyond that each labelled column is joined to its
    labels; a multi-select column through its distinct lists, whose elements are joined
    and put together again. (Streams take literal maps only.)
    """
    targets = [c for c in (columns or df.columns) if c in df.columns]
    if not targets:
        return df
    table = _labels(choices, targets, language)
    rows = table.limit(max_literal + 1).collect()
    labels = None
    if len(rows) <= max_literal:
        labels = {c: {r["_code"]: r["_label"] for r in rows if r["name"] == c} for c in targets}
    if labels is not None:
        out = []
        for c in df.columns:
            mapping = labels.get(c) if c in targets else None
            if not mapping:
                out.append(q(c))
                continue
            m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
            if isinstance(df.schema[c].dataType, ArrayType):
                out.append(F.transform(q(c), _relabel(m)).alias(c))
            else:
                out.append(F.coalesce(F.try_element_at(m, q(c).cast("string")), q(c).cast("string")).alias(c))
        return df.select(*out)
    result = df
    for c in [r["name"] for r in table.select("name").distinct().collect()]:
        lab = table.where(F.col("name") == c).select("_code", "_label")
        if isinstance(df.schema[c].dataType, ArrayType):
            key = F.to_json(F.struct(q(c).alias("v")), {"ignoreNullFields": "false"})
            lists = df.where(q(c).isNotNull()).select(key.alias("_list"), q(c).cast("array<string>").alias("_v")).groupBy("_list").agg(F.first("_v").alias("_v"))
            parts = lists.select("_list", F.posexplode_outer("_v").alias("_pos", "_element"))
            parts = left_lookup(parts, F.col("_element"), lab, "_code")
            element = F.struct("_pos", F.coalesce("_label", "_element").alias("e"))
            whole = parts.groupBy("_list").agg(F.array_sort(F.collect_list(F.when(F.col("_pos").isNotNull(), element))).alias("_es"))
            whole = whole.select("_list", F.transform("_es", lambda x: x["e"]).alias("_label"))
            result = left_lookup(result, F.when(q(c).isNotNull(), key), whole, "_list")
        else:
            result = left_lookup(result, q(c).cast("string"), lab, "_code")
            result = result.withColumn("_label", F.coalesce(F.col("_label"), q(c).cast("string")))
        result = result.withColumn(c, F.col("_label")).drop("_label")
    return result
