"""Registered queries over files, tables and streams that the first catalog does not
reach, and the numbers that make sort orders comparable. Importing the module registers
them beside the others."""

from __future__ import annotations

from pyspark.sql import functions as F

from formwork.functions.coerce import blank_nulls, cast_expected
from formwork.operators.columns import canonical_sort, geo_sort, q, sheet_sort, sort_by_label
from formwork.operators.fingerprint import is_empty, row_count
from formwork.operators.importer import combine_outcomes, create_outbox, route_import, split_create_update, update_outbox
from formwork.operators.onehot import category_dictionary, sparse_flags
from formwork.operators.geo import decode_geometries
from formwork.plans.catalog import (
    EDITOR,
    EVENT_TAGS,
    FORM_ID,
    LATEST_VERSION,
    ORACLE,
    RUN_EPOCH,
    _combined_submissions,
    _event_choices,
    _event_submissions,
    _geometry_text,
    _instances,
    _KIND_SQL,
    _NS_SQL,
    _ORDER_CHOICES_SQL,
    _ORDER_FIELDS_SQL,
    _ORDER_VALID_SQL,
    _part_documents,
    _uuid_sql,
    order_rules,
    register,
    table,
)
from formwork.plans.jobs import extract_metadata_sheets
from formwork.session import scratch_path
from formwork.sinks.writers import write_file, write_geojson_lines
from formwork.sources.readers import read_form_definition, read_geometries
from formwork.streaming.incremental import read_latest, run_latest_extract


@register(
    "sort_positions",
    """SELECT 'canonical' AS sort, CAST(o_orderkey AS VARCHAR) AS id, row_number() OVER (ORDER BY o_orderstatus, prio NULLS FIRST, o_orderkey) AS position
       FROM (SELECT o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS prio, o_orderkey FROM orders)
       UNION ALL
       SELECT 'label', name || choice_value, row_number() OVER (ORDER BY label NULLS FIRST, name, choice_value)
       FROM (SELECT NULLIF(p_type, 'SMALL') AS label, p_brand AS name, CAST(p_partkey AS VARCHAR) AS choice_value FROM part)
       UNION ALL
       SELECT 'sheet', CAST(c_custkey AS VARCHAR), row_number() OVER (ORDER BY segment NULLS FIRST, c_acctbal, c_custkey)
       FROM (SELECT NULLIF(c_mktsegment, 'BUILDING') AS segment, c_acctbal, c_custkey FROM customer)
       UNION ALL
       SELECT 'geo', CAST(c_custkey AS VARCHAR), row_number() OVER (ORDER BY segment NULLS LAST, geometry NULLS LAST, c_custkey)
       FROM (SELECT NULLIF(c_mktsegment, 'BUILDING') AS segment, CASE WHEN c_custkey % 3 > 0 THEN '{"x":' || c_custkey % 9 || '}' END AS geometry, c_custkey FROM customer)""",
)
def q_sort_positions(spark, sf_dir):
    """The place of every row in each of the four orders."""
    o = table(spark, sf_dir, "orders").select("o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"), "o_orderkey")
    p = table(spark, sf_dir, "part").select(F.nullif("p_type", F.lit("SMALL")).alias("label"), F.col("p_brand").alias("name"), F.col("p_partkey").cast("string").alias("choice_value"))
    c = table(spark, sf_dir, "customer").select(F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal", "c_custkey")
    g = c.select("segment", F.when(F.col("c_custkey") % 3 > 0, F.struct((F.col("c_custkey") % 9).alias("x"))).alias("geometry"), "c_custkey")
    parts = [
        ("canonical", canonical_sort(o, position="position"), q("o_orderkey").cast("string")),
        ("label", sort_by_label(p, position="position"), F.concat("name", "choice_value")),
        ("sheet", sheet_sort(c, position="position"), q("c_custkey").cast("string")),
        ("geo", geo_sort(g, position="position"), q("c_custkey").cast("string")),
    ]
    out = [df.select(F.lit(name).alias("sort"), i.alias("id"), "position") for name, df, i in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@register(
    "sparse_flags",
    """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN [o_orderpriority, 'c' || o_orderkey, NULL, o_orderpriority] END AS tags, [o_orderstatus] AS marks FROM orders),
            d AS (SELECT "column", value, row_number() OVER (ORDER BY "column", value) - 1 AS flag FROM (
                    SELECT DISTINCT 'tags' AS "column", unnest(tags) AS value FROM r UNION SELECT DISTINCT 'marks', unnest(marks) FROM r) WHERE value IS NOT NULL)
       SELECT o_orderkey, array_to_string(list_sort(list(DISTINCT flag)), ',') AS flags
       FROM (SELECT o_orderkey, 'tags' AS "column", unnest(tags) AS value FROM r UNION ALL SELECT o_orderkey, 'marks', unnest(marks) FROM r) JOIN d USING ("column", value)
       GROUP BY o_orderkey""",
)
def q_sparse_flags(spark, sf_dir):
    """A2 + F3 with a category of its own in nearly every row, and hot ones."""
    tags = F.array("o_orderpriority", F.concat(F.lit("c"), q("o_orderkey").cast("string")), F.lit(None).cast("string"), "o_orderpriority")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, tags).alias("tags"), F.array("o_orderstatus").alias("marks"))
    out = sparse_flags(rows, category_dictionary(rows))
    return out.select("o_orderkey", F.array_join(F.col("flags").cast("array<string>"), ",").alias("flags"))


@register("resent_extract", ORACLE["submissions_extract"])
def q_resent_extract(spark, sf_dir):
    """S2 + P7 on a stream in which every submission comes twice or more, earlier versions
    first or last: keyed state keeps the latest, which equals the batch extract."""
    events = table(spark, sf_dir, "events")
    root = scratch_path(spark, "resent")
    earlier = events.withColumn("ts", (F.col("ts") - F.expr("INTERVAL 1 SECOND")).cast(events.schema["ts"].dataType)).withColumn("value", F.lit(-1.0)).select(*[F.col(f.name).cast(f.dataType) for f in events.schema.fields])
    odd = F.col("event_id") % 2 == 1
    for n, sent in enumerate((earlier.where(odd), events, earlier.where(~odd), events.where(F.col("event_id") % 3 == 0))):
        sent.coalesce(1).write.parquet(f"{root}/in/sent={n}")
    labels = _event_choices(spark).withColumn("name", F.lit("Type d'événement"))
    run_latest_extract(
        spark, f"{root}/in/sent=*/*.parquet", f"{root}/out", f"{root}/checkpoint", events.schema, {"etiquettes": EVENT_TAGS},
        since="2024-01-15", updated_col="ts", prepare=_event_submissions, choices=labels, max_files_per_trigger=1,
    )
    return read_latest(spark, f"{root}/out")


@register(
    "metadata_sheets",
    """WITH v AS (SELECT *, max(p_size) OVER (PARTITION BY p_brand) AS latest, min(p_partkey) OVER (PARTITION BY p_brand, p_size) AS one FROM part),
            d AS (SELECT * FROM v WHERE p_size = latest AND p_partkey = one)
       SELECT 'questions' AS sheet, p_brand AS form_id, CAST(p_size AS VARCHAR) AS version, 'q' || p_partkey AS name,
              CASE WHEN p_type = 'SMALL' THEN 'text' ELSE 'select_one q' || p_partkey END AS value, p_name AS label FROM d
       UNION ALL
       SELECT 'choices', p_brand, CAST(p_size AS VARCHAR), 'q' || p_partkey, 'c' || i, upper(string_split(p_name, ' ')[i])
       FROM (SELECT *, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM d WHERE p_type <> 'SMALL')""",
)
def q_metadata_sheets(spark, sf_dir):
    """S4 + A1 + F19 + F18: documents stored as JSON lines, the latest of each form, and
    its two sheets on their own."""
    path = scratch_path(spark, "documents")
    first = table(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("p_partkey"))
    docs = _part_documents(spark, sf_dir).withColumn("_key", F.substring(F.map_keys("questions")[0], 2, 20).cast("bigint"))
    docs = docs.join(first.select(F.col("p_partkey").alias("_key")), "_key", "left_semi").drop("_key")
    write_file(docs, path, "json")
    questions, choices = extract_metadata_sheets(spark, path)
    return questions.select(F.lit("questions").alias("sheet"), "form_id", "version", "name", F.col("type").alias("value"), "label").unionByName(
        choices.select(F.lit("choices").alias("sheet"), "form_id", "version", "name", F.col("choice_value").alias("value"), F.col("choice_label").alias("label")))


@register(
    "stored_definition",
    """WITH s AS (SELECT CAST(p_size AS VARCHAR) AS form_version, p_partkey, p_name, p_type FROM part)
       SELECT kind, form_version, name, value FROM (
         SELECT 'latest' AS kind, form_version, CAST(p_partkey AS VARCHAR) AS name, p_name AS value FROM s WHERE CAST(form_version AS BIGINT) = (SELECT max(p_size) FROM part)
         UNION ALL SELECT 'fixed', form_version, CAST(p_partkey AS VARCHAR), p_type FROM s WHERE form_version = '7')""",
)
def q_stored_definition(spark, sf_dir):
    """The sheets of a stored definition, the latest version (from CSV, blanks around
    texts, an empty row) and a given one (from Parquet)."""
    root = scratch_path(spark, "definition")
    part = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("form_version"), F.col("p_partkey").cast("string").alias("name"), "p_name", "p_type")
    questions = part.select("form_version", "name", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("label"))
    empty = part.groupBy("form_version").agg(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("label"))
    write_file(questions.unionByName(empty), f"{root}/questions", "csv")
    write_file(part.select("form_version", "name", F.col("p_type").alias("label")), f"{root}/choices", "parquet")
    latest = read_form_definition(spark, root, "questions", fmt="csv")
    fixed = read_form_definition(spark, root, "choices", version="7")
    return latest.select(F.lit("latest").alias("kind"), "form_version", "name", F.col("label").alias("value")).unionByName(
        fixed.select(F.lit("fixed").alias("kind"), "form_version", "name", F.col("label").alias("value")))


@register(
    "geometry_files",
    f"""SELECT 'lines' AS kind, CAST(c_custkey AS VARCHAR) AS id, {_KIND_SQL} AS geometry_type FROM customer
        UNION ALL SELECT 'lookup', CAST(c_custkey AS VARCHAR), {_KIND_SQL} FROM customer""",
)
def q_geometry_files(spark, sf_dir):
    """Features written as lines and read back; a geometry lookup read from
    JSON and decoded (F6)."""
    root = scratch_path(spark, "geometries")
    units = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), _geometry_text().alias("geometry"))
    write_geojson_lines(decode_geometries(units), f"{root}/lines")
    write_file(units, f"{root}/lookup", "json")
    line = F.col("value")
    lines = spark.read.text(f"{root}/lines").select(F.lit("lines").alias("kind"), F.get_json_object(line, "$.properties.id").alias("id"), F.get_json_object(line, "$.geometry.type").alias("geometry_type"))
    lookup = decode_geometries(read_geometries(spark, f"{root}/lookup", fmt="json"))
    return lines.unionByName(lookup.select(F.lit("lookup").alias("kind"), F.col("id").cast("string").alias("id"), F.col("geometry.kind").alias("geometry_type")))


@register(
    "cast_columns",
    """SELECT o_orderkey, o_custkey AS customer, CAST(o_totalprice AS VARCHAR) AS price, COALESCE(NULLIF(o_orderstatus, 'O'), '') AS status,
              CAST(CAST(o_orderdate AS VARCHAR) AS VARCHAR) AS day, (SELECT count(*) FROM orders) AS n_rows, false AS empty, true AS none_empty FROM orders""",
)
def q_cast_columns(spark, sf_dir):
    """F15 (wrong types cast, a choice of types left alone), P11 (nulls blanked) and A5."""
    o = table(spark, sf_dir, "orders")
    subs = o.select("o_orderkey", q("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").alias("price"),
                    F.nullif("o_orderstatus", F.lit("O")).alias("status"), q("o_orderdate").cast("string").alias("day"))
    out = cast_expected(subs, {"customer": ("Int64", "string"), "price": ("String", "double"), "day": ("Date or Datetime or String", "string")})
    blanked = out.select("o_orderkey", "customer", "price", *blank_nulls(["status"]), "day")
    return blanked.select("*", F.lit(row_count(o)).cast("bigint").alias("n_rows"), F.lit(is_empty(o)).alias("empty"), F.lit(is_empty(o.where("o_orderkey < 0"))).alias("none_empty"))


_COMBINED_SQL = f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey END AS id,
                       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN md5(CAST(o_orderkey AS VARCHAR)) END AS sent,
                       CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_custkey END AS org, o_orderstatus, o_orderpriority, o_totalprice,
                       {_uuid_sql("'{\"o_orderkey\":' || o_orderkey || '}'")} AS made,
                       ({_ORDER_VALID_SQL}) AND ({_ORDER_CHOICES_SQL}) AS valid FROM orders),
     r AS (SELECT *, CASE WHEN id IS NULL AND org IS NOT NULL THEN 'create' WHEN id IS NOT NULL THEN 'update' ELSE 'unrouted' END AS route FROM s),
     w AS (SELECT *, CASE route WHEN 'create' THEN CASE WHEN NOT valid THEN 'invalid' END
                          WHEN 'update' THEN CASE WHEN NOT valid THEN 'invalid' WHEN sent IS NULL THEN 'missing_instance_id' WHEN o_orderkey % 7 = 0 THEN 'locked' END END AS reason FROM r),
     o AS (SELECT o_orderkey, CASE WHEN route = 'unrouted' THEN 'unrouted' WHEN reason IS NOT NULL THEN 'ignored' WHEN route = 'create' THEN 'imported' ELSE 'updated' END AS outcome, reason,
              CASE WHEN route = 'update' THEN id END AS instance_id,
              CASE WHEN reason IS NOT NULL OR route = 'unrouted' THEN NULL WHEN route = 'create' THEN made ELSE sent END AS instance_uuid,
              CASE WHEN reason IS NOT NULL OR route = 'unrouted' THEN NULL
                   WHEN route = 'create' THEN '<data {_NS_SQL}' || chr(10) || '      id="{FORM_ID}" version="{LATEST_VERSION}">' || chr(10)
                        || '    <grp>' || chr(10) || {_ORDER_FIELDS_SQL} || '    </grp>' || chr(10) || '    <meta>' || chr(10)
                        || '        <instanceID>uuid:' || made || '</instanceID>' || chr(10) || '    </meta>' || chr(10) || '</data>'
                   ELSE '<?xml version="1.0" encoding="utf-8"?>' || chr(10) || '<data {_NS_SQL} id="{FORM_ID}" version="{LATEST_VERSION}" instance="'
                        || id || '">' || chr(10) || '    <grp>' || chr(10) || {_ORDER_FIELDS_SQL} || '    </grp>' || chr(10) || '    <meta>' || chr(10)
                        || '        <instanceID>uuid:' || sent || '</instanceID>' || chr(10) || '    <editUserID>{EDITOR}</editUserID></meta>' || chr(10) || '</data>' END AS document,
              CASE WHEN route = 'update' THEN reason IS NULL AND COALESCE(org <> 0, false) ELSE false END AS patch_org_unit
           FROM w)"""


@register("import_rows", _COMBINED_SQL + " SELECT 'one pass' AS mode, * FROM o UNION ALL SELECT 'by parts', * FROM o WHERE outcome <> 'unrouted'")
def q_import_rows(spark, sf_dir):
    """K7 row by row: the combined import in one pass, and the same rows split (P8),
    imported each by its own mode (K4, K5) and put together (U2)."""
    subs, rules = _combined_submissions(spark, sf_dir), order_rules(spark)
    locks = _instances(spark, sf_dir)
    columns = ["o_orderkey", "outcome", "reason", "instance_id", "instance_uuid", "document", "patch_org_unit"]
    whole = route_import(subs, "CREATE_AND_UPDATE", rules, FORM_ID, instances=locks, editor=EDITOR, latest_version_id=LATEST_VERSION,
                         created_at=RUN_EPOCH, key_cols=["o_orderkey"], keep=["o_orderkey"])
    create, update, _ = split_create_update(subs)
    parts = combine_outcomes(
        create_outbox(create, rules, FORM_ID, latest_version_id=LATEST_VERSION, created_at=RUN_EPOCH, key_cols=["o_orderkey"], keep=["o_orderkey"]),
        update_outbox(update, rules, FORM_ID, instances=locks, editor=EDITOR, latest_version_id=LATEST_VERSION, keep=["o_orderkey"]),
    )
    return whole.select(F.lit("one pass").alias("mode"), *columns).unionByName(parts.select(F.lit("by parts").alias("mode"), *columns))
