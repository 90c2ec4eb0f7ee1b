"""Registered queries over the driver tables, each with its DuckDB oracle.

Form-like inputs (submissions, org units, rules, geometries) are derived from the
driver tables inside the query, in Spark and in SQL alike, so every query's work grows
with the tables. Rule tables (questions, choices, label lists) are small literal inputs,
as form definitions are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formwork.functions.rules import calculate, check_constraint
from formwork.functions.text import KEEP_CLASS, WHITESPACE_CLASS, clean_string, strip_strings
from formwork.functions.coerce import TYPE_NAMES, flatten_for_text, text_to_number
from formwork.operators.columns import canonical_columns, canonical_sort, clean_column_names, geo_sort, sheet_sort, sort_by_label
from formwork.operators.forms import (
    first_available,
    latest_version,
    questions_with_choices,
    replace_labels,
)
from formwork.operators.geo import decode_geometries, geojson_feature, merged_arcs, polygon_rings, shared_arcs
from formwork.operators.importer import create_outbox, delete_outbox, outcome_summary, route, route_import, update_outbox
from formwork.operators.onehot import flatten_submissions
from formwork.operators.orgunits import attach_geometry, filter_org_unit_type, project_org_units
from formwork.operators.validate import (
    Rules,
    check_table_schema,
    rules_from_rows,
    choice_membership,
    select_rules,
    table_columns,
    validate_rows,
    validate_rows_by_version,
    validate_structure,
    valid_rows,
)
from formwork.session import scratch_path
from formwork.sinks.writers import MANIFEST, append_once, snapshot_if_changed, write_file
from formwork.sources.readers import read_form_submissions, read_org_units, read_submissions
from formwork.streaming.incremental import run_incremental_extract

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[{WHITESPACE_CLASS}]+|[{WHITESPACE_CLASS}]+$', '', 'g')"


def _clean_sql(x: str) -> str:
    return f"lower(replace({_strip_sql(f'''regexp_replace(strip_accents({x}), '[^{KEEP_CLASS}]', '', 'g')''')}, ' ', '_'))"


# ---------------------------------------------------------------------------
# Names and multi-select flattening
# ---------------------------------------------------------------------------


@register("clean_names", f"SELECT doc_id, {_clean_sql('text')} AS clean_text FROM documents")
def q_clean_names(spark, sf_dir):
    """F1 over whole document texts."""
    return table(spark, sf_dir, "documents").select("doc_id", clean_string("text").alias("clean_text"))


@register(
    "dedupe_columns",
    """SELECT c_custkey AS cle_1, c_name AS nom_2, n_nationkey AS cle_2, n_name AS nom_3, c_nationkey AS nom_1,
              n_name || '/' || c_mktsegment AS region_nom
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def q_dedupe_columns(spark, sf_dir):
    """Repeated and colliding names after cleaning (D-1)."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    raw = c.join(n, c.c_nationkey == n.n_nationkey).select(
        c.c_custkey.alias("Clé"), c.c_name.alias("Nom"), n.n_nationkey.alias("CLÉ"), n.n_name.alias("Nom!"),
        c.c_nationkey.alias("nom_1"), F.concat(n.n_name, F.lit("/"), c.c_mktsegment).alias("Région (nom)"),
    )
    return clean_column_names(raw)


PART_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget"]


@register(
    "one_hot",
    "SELECT p_partkey AS instanceid, p_brand, p_size, "
    + ", ".join(f"CAST(list_contains(string_split(p_name, ' '), '{w}') AS TINYINT) AS words_{w}" for w in PART_WORDS)
    + " FROM part",
)
def q_one_hot(spark, sf_dir):
    """F3 + A2 + P5 + P3 + O1: the submissions flattening on part names."""
    part = table(spark, sf_dir, "part")
    df = part.select(F.col("p_partkey").alias("instanceid"), "p_brand", "p_size", F.split("p_name", " ").alias("words"))
    return flatten_submissions(df)


@register(
    "canonical_table",
    "SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders "
    "ORDER BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
)
def q_canonical_table(spark, sf_dir):
    """P3 + O1."""
    orders = table(spark, sf_dir, "orders")
    return canonical_sort(canonical_columns(orders), list(orders.columns))


@register(
    "updated_since",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'",
)
def q_updated_since(spark, sf_dir):
    """S2 + P7: cut-off pushed to the Parquet scan."""
    return read_form_submissions(spark, f"{sf_dir.rstrip('/')}/events.parquet", since="2024-01-15", updated_col="ts")


# Fixed rule table for the label queries (French labels, one code left without label).
EVENT_LABELS = [
    ("event_type", "view", "Vue", "French"),
    ("event_type", "click", "Clic", "French"),
    ("event_type", "purchase", "Achat", "French"),
    ("event_type", "signup", "Inscription", "French"),
    ("event_type", "view", "View", "English"),
    ("event_type", "error", "Error", "English"),
]


def _event_choices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_LABELS, "name string, choice_value string, choice_label string, language string")


@register(
    "replace_labels",
    """SELECT event_id,
              CASE event_type WHEN 'view' THEN 'Vue' WHEN 'click' THEN 'Clic' WHEN 'purchase' THEN 'Achat'
                   WHEN 'signup' THEN 'Inscription' ELSE event_type END AS event_type,
              array_to_string([CASE event_type WHEN 'view' THEN 'Vue' WHEN 'click' THEN 'Clic' WHEN 'purchase' THEN 'Achat'
                   WHEN 'signup' THEN 'Inscription' ELSE event_type END, 'Vue'], '|') AS seen
       FROM events""",
)
def q_replace_labels(spark, sf_dir):
    """Single and multi-select code columns to French labels."""
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", F.array("event_type", F.lit("view")).alias("seen"))
    choices = _event_choices(spark).union(
        spark.createDataFrame([("seen", v, lab, lang) for _, v, lab, lang in EVENT_LABELS], "name string, choice_value string, choice_label string, language string")
    )
    out = replace_labels(ev, choices, ["event_type", "seen"], language="French")
    return out.select("event_id", "event_type", F.array_join("seen", "|").alias("seen"))


@register(
    "submissions_extract",
    """SELECT CASE WHEN value > 100 THEN 1 ELSE 0 END::TINYINT AS etiquettes_gros,
              CASE WHEN value > 100 THEN 0 ELSE 1 END::TINYINT AS etiquettes_petit,
              """
    + ", ".join(
        f"CASE WHEN event_type = '{code}' THEN 1 ELSE 0 END::TINYINT AS etiquettes_{code}"
        for code in ("click", "error", "purchase", "signup", "view")
    )
    + """,
              event_id AS instanceid,
              CASE event_type WHEN 'view' THEN 'Vue' WHEN 'click' THEN 'Clic' WHEN 'purchase' THEN 'Achat'
                   WHEN 'signup' THEN 'Inscription' ELSE event_type END AS type_devenement,
              ts AS updated_at, user_id AS utilisateur, value AS valeur
       FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
)
def q_submissions_extract(spark, sf_dir):
    """The submissions extract end to end: S2 + P7 + J3 + P4 + F3 + P5 + P3 + O1."""
    ev = read_form_submissions(spark, f"{sf_dir.rstrip('/')}/events.parquet", since="2024-01-15", updated_col="ts")
    labelled = replace_labels(_event_submissions(ev), _event_choices(spark).withColumn("name", F.lit("Type d'événement")), ["Type d'événement"], "French")
    return flatten_submissions(clean_column_names(labelled))


def _event_submissions(ev: DataFrame) -> DataFrame:
    """Events as form submissions: messy headings, a multi-select answer."""
    return ev.select(
        F.col("event_id").alias("instanceID"),
        F.col("event_type").alias("Type d'événement"),
        F.col("value").alias("Valeur"),
        F.col("user_id").alias("Utilisateur"),
        F.split(F.concat_ws(" ", "event_type", F.when(F.col("value") > 100, "gros").otherwise("petit")), " ").alias("Étiquettes"),
        F.col("ts").alias("updated_at"),
    )


# Fixed rule table: the choice list of the multi-select answer (from the form, not the data).
EVENT_TAGS = ["click", "error", "gros", "petit", "purchase", "signup", "view"]


@register("incremental_extract", ORACLE["submissions_extract"])
def q_incremental_extract(spark, sf_dir):
    """The submissions extract as a Structured Streaming run (file source,
    ``availableNow``, checkpoint under the shared checkpoint folder); flag columns come
    from the form's choice list. Returns what the run appended to its sink."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    root = scratch_path(spark, "incremental")
    labels = _event_choices(spark).withColumn("name", F.lit("Type d'événement"))
    run_incremental_extract(
        spark, f"{sf_dir.rstrip('/')}/events.parque[t]", f"{root}/out", f"{root}/checkpoint", spark.read.parquet(path).schema,
        {"etiquettes": EVENT_TAGS}, since="2024-01-15", updated_col="ts", prepare=_event_submissions, choices=labels,
        base_path=sf_dir.rstrip("/"),
    )
    return spark.read.parquet(f"{root}/out")


# ---------------------------------------------------------------------------
# Form metadata
# ---------------------------------------------------------------------------


def _part_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents: one per part (a fragment of version p_size of form p_brand)."""
    part = table(spark, sf_dir, "part")
    qname = F.concat(F.lit("q"), F.col("p_partkey").cast("string"))
    qtype = F.when(F.col("p_type") == "SMALL", F.lit("text")).otherwise(F.concat(F.lit("select_one "), qname))
    question = F.struct(qname.alias("name"), qtype.alias("type"), F.col("p_name").alias("label"), F.lit(None).cast("string").alias("calculate"))
    words = F.split("p_name", " ")
    options = F.transform(words, lambda w, i: F.struct(F.concat(F.lit("c"), (i + 1).cast("string")).alias("name"), F.upper(w).alias("label")))
    choices = F.when(F.col("p_type") == "SMALL", F.create_map().cast("map<string,array<struct<name:string,label:string>>>")).otherwise(F.create_map(qname, options))
    return part.select(
        F.col("p_brand").alias("form_id"), F.col("p_size").cast("string").alias("version"),
        F.create_map(qname, question).alias("questions"), choices.alias("choices"),
    )


@register(
    "questions_choices",
    """WITH docs AS (SELECT p_brand AS form_id, CAST(p_size AS VARCHAR) AS version, p_partkey, p_name, p_type FROM part),
       latest AS (SELECT form_id, max(TRY_CAST(version AS BIGINT)) AS v FROM docs GROUP BY form_id),
       qs AS (SELECT d.form_id, d.version, 'q' || d.p_partkey AS name,
                     CASE WHEN d.p_type = 'SMALL' THEN 'text' ELSE 'select_one q' || d.p_partkey END AS type,
                     d.p_name AS label, CAST(NULL AS VARCHAR) AS calculate, d.p_type, d.p_name
              FROM docs d JOIN latest l ON d.form_id = l.form_id AND TRY_CAST(d.version AS BIGINT) = l.v),
       cs AS (SELECT form_id, version, name, 'c' || i AS choice_value, upper(string_split(p_name, ' ')[i]) AS choice_label
              FROM (SELECT *, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM qs WHERE p_type <> 'SMALL'))
       SELECT qs.form_id, qs.version, qs.name, qs.type, qs.label, qs.calculate, cs.choice_value, cs.choice_label
       FROM qs LEFT JOIN cs ON qs.form_id = cs.form_id AND qs.version = cs.version AND qs.name = cs.name
       ORDER BY qs.label, qs.name, cs.choice_value""",
)
def q_questions_choices(spark, sf_dir):
    """A1 + F19 + F18 + J1 + O2: metadata documents (several parts of a version) to the
    questions-choices sheet."""
    docs = latest_version(_part_documents(spark, sf_dir), "form_id", "version")
    return sort_by_label(questions_with_choices(docs))


@register(
    "latest_version",
    """SELECT o_custkey, max(o_orderkey) AS latest_orderkey, arg_max(o_totalprice, o_orderkey) AS latest_totalprice,
              arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority <> '5-LOW') AS first_priority
       FROM orders GROUP BY o_custkey""",
)
def q_latest_version(spark, sf_dir):
    """A1 (orders as versions of a customer's form) + A6 (first non-empty value)."""
    o = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_totalprice",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(F.col("o_orderpriority")).alias("prio"),
    )
    latest = latest_version(o, "o_custkey", "o_orderkey").select(
        "o_custkey", F.col("o_orderkey").alias("latest_orderkey"), F.col("o_totalprice").alias("latest_totalprice")
    )
    first = o.groupBy("o_custkey").agg(first_available(F.col("prio"), F.col("o_orderkey")).alias("first_priority"))
    return latest.join(first, "o_custkey")


# ---------------------------------------------------------------------------
# Org units and geometry
# ---------------------------------------------------------------------------


def _org_unit_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The org-unit export as it arrives (French headings, dates as text): customers
    are the units, nation and region the two levels above."""
    c, n, r = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    base = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    hh = F.lpad((F.col("c_custkey") % 24).cast("string"), 2, "0")
    mm = F.lpad((F.col("c_custkey") % 60).cast("string"), 2, "0")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("c_custkey").cast("string").alias("ID"),
            F.col("c_name").alias("Nom"),
            F.col("c_mktsegment").alias("Type"),
            (F.col("c_acctbal") / 1000).alias("Latitude"),
            (F.col("n_nationkey") * 1.5).alias("Longitude"),
            F.date_format(base, "yyyy-MM-dd").alias("Date d'ouverture"),
            F.when(F.col("c_acctbal") < 0, F.date_format(F.date_add(base, 400), "yyyy-MM-dd")).alias("Date de fermeture"),
            F.concat(F.date_format(base, "yyyy-MM-dd"), F.lit(" "), hh, F.lit(":"), mm).alias("Date de création"),
            F.concat(F.date_format(F.date_add(base, 1), "yyyy-MM-dd"), F.lit(" "), hh, F.lit(":"), mm).alias("Date de modification"),
            F.lit("tpch").alias("Source"),
            F.when(F.col("c_acctbal") > 0, F.lit("VALID")).otherwise(F.lit("NEW")).alias("Validé"),
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("Référence externe"),
            F.col("r_regionkey").cast("string").alias("Ref Ext parent 1"),
            F.col("r_name").alias("parent 1"),
            F.col("n_nationkey").cast("string").alias("Ref Ext parent 2"),
            F.col("n_name").alias("parent 2"),
        )
    )


_ORG_BASE_SQL = "(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER))"


@register(
    "org_unit_projection",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS org_unit_type,
               c_acctbal / 1000 AS latitude, CAST(n_nationkey AS DOUBLE) * 1.5 AS longitude,
               {_ORG_BASE_SQL} AS opening_date,
               CASE WHEN c_acctbal < 0 THEN {_ORG_BASE_SQL} + 400 END AS closing_date,
               CAST({_ORG_BASE_SQL} AS TIMESTAMP) + to_hours(CAST(c_custkey % 24 AS BIGINT)) + to_minutes(CAST(c_custkey % 60 AS BIGINT)) AS created_at,
               CAST({_ORG_BASE_SQL} + 1 AS TIMESTAMP) + to_hours(CAST(c_custkey % 24 AS BIGINT)) + to_minutes(CAST(c_custkey % 60 AS BIGINT)) AS updated_at,
               'tpch' AS source, CASE WHEN c_acctbal > 0 THEN 'VALID' ELSE 'NEW' END AS validation_status,
               'C' || c_custkey AS source_ref,
               CAST(r_regionkey AS VARCHAR) AS level_1_ref, CAST(n_nationkey AS VARCHAR) AS level_2_ref,
               r_name AS level_1_name, n_name AS level_2_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def q_org_unit_projection(spark, sf_dir):
    """P1 + P2 + F2: headings renamed, dates parsed strictly, levels attached."""
    return project_org_units(_org_unit_export(spark, sf_dir))


# Fixed rule table: organisation unit types.
UNIT_TYPES = [(1, "AUTOMOBILE"), (2, "BUILDING"), (3, "FURNITURE"), (4, "HOUSEHOLD"), (5, "MACHINERY")]


@register(
    "org_unit_type_filter",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS org_unit_type FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def q_org_unit_type_filter(spark, sf_dir):
    """Type looked up by id, units restricted to it."""
    units = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("org_unit_type")
    )
    types = spark.createDataFrame(UNIT_TYPES, "id int, name string")
    return filter_org_unit_type(units, types, 2)


def _geometry_text() -> Column:
    """GeoJSON per customer: bad JSON, an unsupported Polygon, a unit-square multipolygon
    (with a hole when the balance is high) or a point, chosen from the row's values."""
    k = F.col("c_custkey")
    x, y = (k % 40).cast("string"), F.expr("c_custkey div 40").cast("string")
    x1, y1 = (k % 40 + 1).cast("string"), (F.expr("c_custkey div 40") + 1).cast("string")
    xa, ya = (k % 40 + 0.25).cast("string"), (F.expr("c_custkey div 40") + 0.25).cast("string")
    xb, yb = (k % 40 + 0.75).cast("string"), (F.expr("c_custkey div 40") + 0.75).cast("string")

    def ring(ax, ay, bx, by):
        pts = [(ax, ay), (bx, ay), (bx, by), (ax, by), (ax, ay)]
        return F.concat(F.lit("["), F.concat_ws(", ", *[F.concat(F.lit("["), px, F.lit(", "), py, F.lit("]")) for px, py in pts]), F.lit("]"))

    shell = ring(x, y, x1, y1)
    hole = ring(xa, ya, xb, yb)
    rings = F.when(F.col("c_acctbal") > 5000, F.concat(shell, F.lit(", "), hole)).otherwise(shell)
    multi = F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [['), rings, F.lit("]]}"))
    point = F.concat(
        F.lit('{"type": "Point", "coordinates": ['), (F.col("c_nationkey") * 7 - 80).cast("string"), F.lit(", "),
        (k % 120 - 60).cast("string"), F.lit("]}"),
    )
    return (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit('{"type": "Point", "coordinates": [1, '))
        .when(F.col("c_acctbal") < 0, F.lit('{"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}'))
        .when(F.col("c_mktsegment") == "MACHINERY", multi)
        .otherwise(point)
    )


def _geometries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), _geometry_text().alias("geometry"))


_KIND_SQL = """CASE WHEN c_mktsegment = 'HOUSEHOLD' OR c_acctbal < 0 THEN NULL
                    WHEN c_mktsegment = 'MACHINERY' THEN 'MultiPolygon' ELSE 'Point' END"""


_POINT_SQL = """'{"type": "Point", "coordinates": [' || (c_nationkey * 7 - 80) || ', ' || (c_custkey % 120 - 60) || ']}'"""


@register(
    "attach_geometry",
    f"""SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_acctbal <= 0 THEN NULL
                    WHEN c_mktsegment = 'HOUSEHOLD' THEN '{{"type": "Point", "coordinates": [1, '
                    ELSE {_POINT_SQL} END AS geometry
        FROM customer""",
)
def q_attach_geometry(spark, sf_dir):
    """Geometry lookup with one duplicate per machinery unit (the lookup keeps the
    greatest text, as a dictionary keeps one value per key); units with a non-positive
    balance have no geometry."""
    geoms = _geometries(spark, sf_dir)
    cust = table(spark, sf_dir, "customer")
    extra = cust.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit('{"type": "Point", "coordinates": ['), (F.col("c_nationkey") * 7 - 80).cast("string"), F.lit(", "),
                 (F.col("c_custkey") % 120 - 60).cast("string"), F.lit("]}")).alias("geometry"),
    )
    lookup = geoms.unionByName(extra).join(cust.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("id")), "id", "left_semi")
    units = cust.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return attach_geometry(units, lookup)


@register(
    "decode_points",
    f"""SELECT c_custkey AS id, {_KIND_SQL} AS kind,
               CASE WHEN {_KIND_SQL} = 'Point' THEN CAST(c_nationkey * 7 - 80 AS DOUBLE) END AS lon,
               CASE WHEN {_KIND_SQL} = 'Point' THEN CAST(c_custkey % 120 - 60 AS DOUBLE) END AS lat,
               CASE WHEN {_KIND_SQL} = 'MultiPolygon' THEN 1 END AS n_polygons,
               CASE WHEN {_KIND_SQL} = 'MultiPolygon' THEN CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END END AS n_rings,
               CASE WHEN {_KIND_SQL} = 'MultiPolygon' THEN CASE WHEN c_acctbal > 5000 THEN 2 ELSE 1 END END AS compat_polygons
        FROM customer""",
)
def q_decode_points(spark, sf_dir):
    """point coordinates, polygon and ring counts; bad JSON and Polygon give null.
    ``compat_polygons`` counts polygons in the reference's shape (one per ring of the
    first polygon)."""
    g = decode_geometries(_geometries(spark, sf_dir), "geometry", "geometry", compat_target="compat")
    d, compat = F.col("geometry"), F.col("compat")
    return g.select(
        "id", d["kind"].alias("kind"), d["lon"].alias("lon"), d["lat"].alias("lat"),
        F.when(d["polygons"].isNotNull(), F.size(d["polygons"])).alias("n_polygons"),
        F.when(d["polygons"].isNotNull(), F.size(F.element_at(d["polygons"], 1))).alias("n_rings"),
        F.when(compat["polygons"].isNotNull(), F.size(compat["polygons"])).alias("compat_polygons"),
    )


def _square_text(with_hole: Column | None) -> Column:
    """Unit square of a customer's grid cell as MultiPolygon text (optional hole)."""
    k = F.col("c_custkey")
    x0, y0 = (k % 40).cast("double"), F.expr("c_custkey div 40").cast("double")

    def ring(off: float, size: float) -> Column:
        pts = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
        return F.concat(
            F.lit("["),
            F.concat_ws(", ", *[F.concat(F.lit("["), (x0 + off + size * dx).cast("string"), F.lit(", "), (y0 + off + size * dy).cast("string"), F.lit("]")) for dx, dy in pts]),
            F.lit("]"),
        )

    rings = ring(0.0, 1.0) if with_hole is None else F.when(with_hole, F.concat(ring(0.0, 1.0), F.lit(", "), ring(0.25, 0.5))).otherwise(ring(0.0, 1.0))
    return F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [['), rings, F.lit("]]}"))


@register(
    "polygon_rings",
    """WITH m AS (SELECT c_custkey AS id, c_custkey % 40 AS x, c_custkey // 40 AS y, c_acctbal FROM customer
                 WHERE c_mktsegment = 'MACHINERY' AND c_acctbal >= 0),
            pts AS (SELECT * FROM (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) v(i, dx, dy))
       SELECT id, 0 AS polygon, 0 AS ring, i AS vertex, CAST(x + dx AS DOUBLE) AS x, CAST(y + dy AS DOUBLE) AS y FROM m, pts
       UNION ALL
       SELECT id, 0, 1, i, x + 0.25 + 0.5 * dx, y + 0.25 + 0.5 * dy FROM m, pts WHERE c_acctbal > 5000""",
)
def q_polygon_rings(spark, sf_dir):
    """F6 + F7: multipolygons (squares, some with a hole) to vertex rows."""
    g = decode_geometries(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), _geometry_text().alias("geometry")))
    return polygon_rings(g, "id", "geometry")


@register(
    "geojson_features",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS id, 'Feature' AS type, {_KIND_SQL} AS geometry_type, c_name AS name,
               CAST({_ORG_BASE_SQL} AS VARCHAR) AS opened
        FROM customer""",
)
def q_geojson_features(spark, sf_dir):
    """O4 + F8 (the K8 line format): features read back field by field."""
    base = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    units = decode_geometries(table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), base.alias("opened"),
        _geometry_text().alias("geometry"),
    ))
    feats = geojson_feature(geo_sort(units), "geometry")
    j = F.col("feature")
    return feats.select(
        F.get_json_object(j, "$.properties.id").alias("id"), F.get_json_object(j, "$.type").alias("type"),
        F.get_json_object(j, "$.geometry.type").alias("geometry_type"), F.get_json_object(j, "$.properties.name").alias("name"),
        F.get_json_object(j, "$.properties.opened").alias("opened"),
    )


@register(
    "shared_arcs",
    """WITH cells AS (SELECT c_custkey AS id, CAST(c_custkey % 40 AS DOUBLE) AS x, CAST(c_custkey // 40 AS DOUBLE) AS y FROM customer),
            segs AS (SELECT id, x AS x1, y AS y1, x + 1 AS x2, y AS y2 FROM cells
                     UNION ALL SELECT id, x + 1, y, x + 1, y + 1 FROM cells
                     UNION ALL SELECT id, x, y + 1, x + 1, y + 1 FROM cells
                     UNION ALL SELECT id, x, y, x, y + 1 FROM cells)
       SELECT x1, y1, x2, y2, count(DISTINCT id) AS n_units, min(id) AS unit_min, max(id) AS unit_max
       FROM segs GROUP BY x1, y1, x2, y2""",
)
def q_shared_arcs(spark, sf_dir):
    """K9: every customer is a unit square on a 40-wide grid; borders stored once."""
    g = decode_geometries(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), _square_text(None).alias("geometry")))
    return shared_arcs(g, "id", "geometry")


_BLOCKS_SQL = "SELECT DISTINCT (c_custkey % 40) // 5 AS bx, c_custkey // 200 AS \"by\" FROM customer"
_STEP_SQL = """SELECT p, r, list_sort(list(DISTINCT id)) AS units FROM (
                 SELECT id, least(a, b) AS p, greatest(a, b) AS r FROM (
                   SELECT id, part, {'x': x, 'y': y} AS a, lead({'x': x, 'y': y}) OVER (PARTITION BY id, part ORDER BY t) AS b FROM pts) WHERE b IS NOT NULL)
               GROUP BY p, r"""


@register(
    "merged_arcs",
    f"""WITH RECURSIVE blocks AS ({_BLOCKS_SQL}),
            pts AS (SELECT bx + 8 * "by" AS id, 0 AS part, t,
                           CAST(5 * bx + CASE WHEN t < 5 THEN t WHEN t < 10 THEN 5 WHEN t < 15 THEN 15 - t ELSE 0 END AS DOUBLE) AS x,
                           CAST(5 * "by" + CASE WHEN t < 5 THEN 0 WHEN t < 10 THEN t - 5 WHEN t < 15 THEN 5 ELSE 20 - t END AS DOUBLE) AS y
                    FROM blocks, range(21) r(t)
                    UNION ALL
                    SELECT bx + 8 * "by", 1, t, CAST(5 * bx + 2 + CASE WHEN t IN (1, 2) THEN 1 ELSE 0 END AS DOUBLE), CAST(5 * "by" + 2 + CASE WHEN t IN (2, 3) THEN 1 ELSE 0 END AS DOUBLE)
                    FROM blocks, range(5) r(t) WHERE (bx + "by") % 3 = 0),
            segs AS ({_STEP_SQL}),
            steps AS (SELECT p AS u, r AS v, units FROM segs UNION ALL SELECT r, p, units FROM segs),
            met AS (SELECT u, count(*) = 2 AND min(units) = max(units) AS passed FROM steps GROUP BY u),
            walk AS (SELECT [s.u, s.v] AS vertices, s.units, m.passed AS ring, NOT n.passed OR s.v = s.u AS done
                     FROM steps s JOIN met m ON m.u = s.u JOIN met n ON n.u = s.v
                     UNION ALL
                     SELECT list_append(w.vertices, s.v), w.units, w.ring, NOT n.passed OR s.v = w.vertices[1]
                     FROM walk w JOIN steps s ON s.u = w.vertices[len(w.vertices)] AND s.v <> w.vertices[len(w.vertices) - 1] JOIN met n ON n.u = s.v
                     WHERE NOT w.done AND (NOT w.ring OR w.vertices[len(w.vertices)] > w.vertices[1]))
       SELECT array_to_string(list_transform(vertices, lambda p: concat(CAST(p.x AS BIGINT), ' ', CAST(p.y AS BIGINT))), ', ') AS vertices,
              array_to_string(units, ',') AS units, CAST(len(units) AS INTEGER) AS n_units
       FROM walk WHERE done AND (NOT ring OR vertices[1] = vertices[len(vertices)])
         AND vertices <= list_reverse(vertices)""",
)
def q_merged_arcs(spark, sf_dir):
    """K9: blocks of customers as units with shared borders, some with a hole (a ring
    without junction); each border once, as its vertices in order."""
    blocks = table(spark, sf_dir, "customer").select(F.expr("(c_custkey % 40) div 5").alias("bx"), F.expr("c_custkey div 200").alias("by")).distinct()

    def ring(n: int, x: str, y: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.expr(f"transform(sequence(0, {n}), t -> concat('[', {x}, ', ', {y}, ']'))"), ", "), F.lit("]"))

    outer = ring(20, "5 * bx + CASE WHEN t < 5 THEN t WHEN t < 10 THEN 5 WHEN t < 15 THEN 15 - t ELSE 0 END", "5 * by + CASE WHEN t < 5 THEN 0 WHEN t < 10 THEN t - 5 WHEN t < 15 THEN 5 ELSE 20 - t END")
    hole = ring(4, "5 * bx + 2 + CASE WHEN t IN (1, 2) THEN 1 ELSE 0 END", "5 * by + 2 + CASE WHEN t IN (2, 3) THEN 1 ELSE 0 END")
    rings = F.when((F.col("bx") + F.col("by")) % 3 == 0, F.concat(outer, F.lit(", "), hole)).otherwise(outer)
    text = F.concat(F.lit('{"type": "MultiPolygon", "coordinates": [['), rings, F.lit("]]}"))
    units = decode_geometries(blocks.select((F.col("bx") + 8 * F.col("by")).alias("id"), text.alias("geometry")))
    arcs = merged_arcs(units, "id", "geometry")
    spelt = F.transform("vertices", lambda p: F.concat_ws(" ", p["x"].cast("long"), p["y"].cast("long")))
    return arcs.select(F.array_join(spelt, ", ").alias("vertices"), F.array_join("units", ",").alias("units"), "n_units")


# ---------------------------------------------------------------------------
# Rules and validation
# ---------------------------------------------------------------------------


@register(
    "constraint_range",
    """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS q FROM lineitem)
       SELECT l_orderkey, l_linenumber, COALESCE(q <= 40, false) AS qty_le_40, COALESCE(q >= 5, false) AS qty_ge_5,
              false AS qty_bad_rule, q IS NOT NULL AS qty_other, COALESCE(q <= 40, false) AS qty_text_le_40,
              COALESCE(q >= 5 AND q < 45, false) AS qty_nan_ge_5, COALESCE(q >= 5 AND q < 45, false) AS qty_nan_text_ge_5
       FROM l""",
)
def q_constraint_range(spark, sf_dir):
    """F4 numeric rules on a number column and on its text; a bad threshold is false."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity")).alias("q")
    )
    li = li.withColumn("q_text", F.col("q").cast("string"))
    t = {f.name: f.dataType for f in li.schema.fields}
    return li.select(
        "l_orderkey", "l_linenumber",
        check_constraint("q", ".<=40", t["q"]).alias("qty_le_40"),
        check_constraint("q", ".>=5", t["q"]).alias("qty_ge_5"),
        check_constraint("q", ".<=abc", t["q"]).alias("qty_bad_rule"),
        check_constraint("q", "required-if(other)", t["q"]).alias("qty_other"),
        check_constraint("q_text", ".<=40", t["q_text"]).alias("qty_text_le_40"),
        # NaN is no number that passes a bound
        check_constraint(F.when(F.col("q") < 45, F.col("q")).otherwise(F.lit(float("nan"))), ".>=5", t["q"]).alias("qty_nan_ge_5"),
        check_constraint(F.when(F.col("q") < 45, F.col("q_text")).otherwise(F.lit("nan")), ".>=5", t["q_text"]).alias("qty_nan_text_ge_5"),
    )


@register(
    "constraint_regex",
    """WITH o AS (SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS p FROM orders)
       SELECT o_orderkey, COALESCE(regexp_matches(p, '^(?:[1-3]-)'), false) AS prio_ok,
              COALESCE(regexp_matches(p, '^(?:URGENT)'), false) AS urgent_ok,
              COALESCE(regexp_matches(p, '^(?:\\d-[A-Z]+ [A-Z]+)'), false) AS two_words,
              COALESCE(o_orderkey % 2 = 0 AND p NOT LIKE '% %', false) AS name_ok, o_orderkey % 3 <> 0 AS digit_ok
       FROM o""",
)
def q_constraint_regex(spark, sf_dir):
    """F4 regex rules: match anchored at the start only; null is false."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"))
    key = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        check_constraint("p", "regex(., '[1-3]-')").alias("prio_ok"),
        check_constraint("p", "regex(., 'URGENT')").alias("urgent_ok"),
        check_constraint("p", "regex(., '\\d-[A-Z]+ [A-Z]+')").alias("two_words"),
        # accented letters are word characters, a blank or a dash is none; a line break may end the text
        check_constraint(F.concat(F.when(key % 2 == 0, F.lit("Hélène_")).otherwise(F.lit("H-")), F.replace("p", F.lit("-"), F.lit("Ω")), F.lit("\n")), "regex(., '^[\\w]+$')").alias("name_ok"),
        check_constraint(F.when(key % 3 == 0, F.lit("²")).otherwise(F.lit("٣")), "regex(., '^\\d$')").alias("digit_ok"),
    )


@register(
    "calculate",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax, l_quantity,
                         CASE WHEN l_linestatus = 'O' AND l_quantity < 3 THEN 0 ELSE l_quantity END AS qz,
                         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS qn FROM lineitem)
       SELECT l_orderkey, l_linenumber,
              CAST(round(CASE WHEN qz = 0 THEN NULL ELSE l_extendedprice / qz END) AS BIGINT) AS unit_price,
              CAST(round(abs(l_discount * 100 - l_tax * 100)) AS BIGINT) AS spread,
              CAST(round(COALESCE(qn, 0) + 1) AS BIGINT) AS qty_plus_one,
              CAST(0 AS BIGINT) AS unsupported
       FROM l""",
)
def q_calculate(spark, sf_dir):
    """formulas translated to native expressions; per-row division by zero is null,
    an unsupported formula gives 0."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax", "l_quantity",
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") < 3), F.lit(0.0)).otherwise(F.col("l_quantity")).alias("qz"),
        F.when(F.col("l_returnflag") == "R", F.lit(None)).otherwise(F.col("l_quantity")).alias("qn"),
    )
    cols = {f.name: f.dataType for f in li.schema.fields}  # types let numeric fields skip the text path
    return li.select(
        "l_orderkey", "l_linenumber",
        calculate("round(${l_extendedprice} div ${qz}, 0)", cols)[0].alias("unit_price"),
        calculate("abs(${l_discount} * 100 - ${l_tax} * 100)", cols)[0].alias("spread"),
        calculate("coalesce(${qn}, 0) + 1", cols)[0].alias("qty_plus_one"),
        calculate("${l_quantity} ^ 2", cols)[0].alias("unsupported"),
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@register(
    "choice_membership",
    """SELECT o_orderkey,
              COALESCE(NULLIF(o_orderpriority, '5-LOW') IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false) AS priority_valid,
              false AS status_valid
       FROM orders""",
)
def q_choice_membership(spark, sf_dir):
    """Membership in the list named like the question; empty list -> false."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("p"), "o_orderstatus")
    return o.select(
        "o_orderkey",
        choice_membership(F.col("p"), PRIORITIES[:3]).alias("priority_valid"),
        choice_membership(F.col("o_orderstatus"), []).alias("status_valid"),
    )


# Fixed rule tables of the order "form".
ORDER_QUESTIONS = [
    ("grp", "begin group", None, None, None),
    ("o_orderpriority", "select_one priority", "yes", None, "regex(., '[1-4]-')"),
    ("o_orderstatus", "select_one status", None, None, None),
    ("o_totalprice", "decimal", None, None, ".>=5000"),
    ("total_k", "calculate", None, "round(${o_totalprice} div 1000, 0)", ".<=450"),
]
ORDER_CHOICES = [("o_orderpriority", p) for p in PRIORITIES] + [("o_orderstatus", s) for s in ("F", "O", "P")]
QUESTION_SCHEMA = "name string, type string, required string, calculation string, constraint string"


def order_rules(spark: SparkSession, questions=None, choices=None, from_tables: bool = False) -> Rules:
    """Rules of the order "form". The rule tables are literal, so they are turned into
    ``Rules`` on the driver directly; ``from_tables`` goes through DataFrames and
    ``select_rules`` (P9) as a definition read from storage would."""
    qrows = questions or ORDER_QUESTIONS
    crows = ORDER_CHOICES if choices is None else choices
    if from_tables:
        qs = spark.createDataFrame(qrows, QUESTION_SCHEMA)
        cs = spark.createDataFrame(crows, "list_name string, label string")
        return select_rules(qs, cs)
    names = QUESTION_SCHEMA.replace(" string", "").split(", ")
    return rules_from_rows([dict(zip(names, r)) for r in qrows], list(crows))


_PRIO_IN = "(" + ", ".join(f"'{p}'" for p in PRIORITIES) + ")"
_ORDER_VALID_SQL = f"""COALESCE(regexp_matches(o_orderpriority, '^(?:[1-4]-)'), false) AND COALESCE(o_totalprice >= 5000, false)
                 AND COALESCE(CAST(round(o_totalprice / 1000) AS BIGINT) <= 450, false)"""
_ORDER_CHOICES_SQL = f"COALESCE(o_orderpriority IN {_PRIO_IN}, false) AND COALESCE(o_orderstatus IN ('F', 'O', 'P'), false)"


@register(
    "validate_rows",
    f"""WITH o AS (SELECT NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority, o_orderkey, o_orderstatus, o_totalprice FROM orders),
            f AS (SELECT o_orderkey, CAST(round(o_totalprice / 1000) AS BIGINT) AS total_k,
                         {_ORDER_VALID_SQL} AS constraints_validation_summary,
                         COALESCE(o_orderpriority IN {_PRIO_IN}, false) AS o_orderpriority_choices_valid,
                         COALESCE(o_orderstatus IN ('F', 'O', 'P'), false) AS o_orderstatus_choices_valid FROM o)
       SELECT *, o_orderpriority_choices_valid AND o_orderstatus_choices_valid AS choices_validation_summary
       FROM f WHERE constraints_validation_summary AND o_orderpriority_choices_valid AND o_orderstatus_choices_valid""",
)
def q_validate_rows(spark, sf_dir):
    """V2 + A4 + V4 + P12: calculated column, constraint and choice summaries, strict
    filter."""
    o = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"), "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    checked = valid_rows(validate_rows(o, order_rules(spark, from_tables=True)), strict=True)
    return checked.select(
        "o_orderkey", "total_k", "constraints_validation_summary", "o_orderpriority_choices_valid",
        "o_orderstatus_choices_valid", "choices_validation_summary",
    )


def version_rules(spark: SparkSession) -> dict[str, Rules]:
    f_rules = order_rules(spark, [("o_orderpriority", "text", None, None, "regex(., '[1-2]-')"),
                                  ("double_k", "calculate", None, "round(${o_totalprice} div 500, 0)", None)], [])
    o_rules = order_rules(spark, [("o_totalprice", "decimal", None, None, ".>=100000"),
                                  ("o_orderpriority", "select_one priority", None, None, None)],
                          [("o_orderpriority", p) for p in PRIORITIES[:3]])
    return {"F": f_rules, "O": o_rules}


@register(
    "validate_by_version",
    f"""SELECT o_orderkey, o_orderstatus AS form_version,
               CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice / 500) AS BIGINT) END AS double_k,
               CASE o_orderstatus WHEN 'F' THEN COALESCE(regexp_matches(o_orderpriority, '^(?:[1-2]-)'), false)
                                  WHEN 'O' THEN COALESCE(o_totalprice >= 100000, false)
                                                AND COALESCE(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'), false)
                                  ELSE false END AS row_valid,
               o_orderstatus IN ('F', 'O') AS has_template
        FROM orders""",
)
def q_validate_by_version(spark, sf_dir):
    """V3 + J5: each row checked against its own version's rules; a version without
    rules has no template."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("form_version"), "o_orderpriority", "o_totalprice")
    out = validate_rows_by_version(o, version_rules(spark))
    return out.select("o_orderkey", "form_version", "double_k", "row_valid", "has_template")


@register(
    "structure_findings",
    """SELECT * FROM (
         SELECT 'error' AS severity, 'missing_column' AS kind, 'o_clerk' AS "column", NULL AS expected, NULL AS actual,
                'CREATE needs the column o_clerk' AS message, CAST(NULL AS BIGINT) AS n_values, CAST(NULL AS BIGINT) AS n_uncastable
         UNION ALL
         SELECT 'error', 'invalid_type', 'org_unit_id', 'Int64', 'string',
                'org_unit_id is string, not Int64',
                (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT')
         UNION ALL
         SELECT 'error', 'invalid_type', 'o_totalprice', 'Int64', 'double',
                'o_totalprice is double, not Int64', (SELECT count(*) FROM orders), 0
         UNION ALL
         SELECT 'warning', 'unexpected_column', 'o_comment_x', NULL, NULL, 'o_comment_x belongs to no question',
                (SELECT count(*) FROM orders), NULL)""",
)
def q_structure_findings(spark, sf_dir):
    """V1 + U1 + P9: schema findings of a CREATE import, with per-column value counts
    and the number of values that would fail the cast to the expected type (F15)."""
    o = table(spark, sf_dir, "orders")
    subs = o.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("X"), F.col("o_custkey").cast("string")))
        .otherwise(F.col("o_custkey").cast("string")).alias("org_unit_id"),
        F.col("o_orderdate").alias("created_at"), "o_orderpriority", "o_totalprice",
        F.col("o_orderstatus").alias("o_comment_x"),
    )
    questions = [("o_totalprice", "integer", None, None, None), ("o_clerk", "text", "yes", None, None),
                 ("o_orderpriority", "select_one priority", None, None, None)]
    rules = order_rules(spark, questions, ORDER_CHOICES)
    _, findings, invalid = validate_structure(spark, subs, rules, "CREATE")
    names = [r["column"] for r in findings.select("column").collect() if r["column"] in subs.columns]
    stats = []
    for c in names:
        n_bad = (
            F.count_if(F.col(f"`{c}`").isNotNull() & text_to_number(F.col(f"`{c}`"), TYPE_NAMES[invalid[c][0]], subs.schema[c].dataType).isNull())
            if c in invalid else F.lit(None).cast("bigint")
        )
        stats.append(F.struct(F.lit(c).alias("column"), F.count(F.col(f"`{c}`")).alias("n_values"), n_bad.alias("n_uncastable")))
    counts = subs.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    return findings.join(counts, "column", "left").select(
        "severity", "kind", "column", "expected", "actual", "message", "n_values", "n_uncastable"
    )


# ---------------------------------------------------------------------------
# Import routing and outboxes
# ---------------------------------------------------------------------------

FORM_ID = 77
LATEST_VERSION = "3"
RUN_EPOCH = 1_700_000_000
EDITOR = 42


def _uuid_sql(key: str) -> str:
    h = f"md5({key})"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def _fields_sql(fields: list[tuple[str, str]]) -> str:
    return " || ".join(f"'        <{n}>' || {expr} || '</{n}>' || chr(10)" for n, expr in fields)


_ORDER_FIELDS_SQL = _fields_sql(
    [("o_orderstatus", "o_orderstatus"), ("o_orderpriority", "o_orderpriority"),
     ("o_totalprice", "CAST(o_totalprice AS VARCHAR)"), ("total_k", "CAST(round(o_totalprice / 1000) AS BIGINT)")]
)
_NS_SQL = "xmlns:jr=\"http://openrosa.org/javarosa\" xmlns:orx=\"http://openrosa.org/xforms\""


@register(
    "split_create_update",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'O' AND o_totalprice >= 20000 THEN 'create'
                   WHEN o_orderstatus <> 'O' THEN 'update' ELSE 'unrouted' END AS route
       FROM orders""",
)
def q_split_create_update(spark, sf_dir):
    """Create / update / unrouted (D-10)."""
    subs = _combined_submissions(spark, sf_dir)
    return subs.select("o_orderkey", route(subs).alias("route"))


def _combined_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(key).alias("id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None)).otherwise(F.concat(F.lit("uuid:"), F.md5(key))).alias("instanceID"),
        F.when(F.col("o_totalprice") < 20000, F.lit(None)).otherwise(F.col("o_custkey")).alias("org_unit_id"),
        "o_orderstatus", "o_orderpriority", "o_totalprice",
    )


def _instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Server-side instance table: every order is an instance; some are locked."""
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 7 == 0).alias("is_locked"))


@register(
    "create_outbox",
    f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_custkey END AS org_unit_id,
                          o_orderstatus, o_orderpriority, o_totalprice, round(o_totalprice / 10000, 2) AS latitude,
                          {_uuid_sql("'{\"o_orderkey\":' || o_orderkey || '}'")} AS uuid,
                          ({_ORDER_VALID_SQL}) AND ({_ORDER_CHOICES_SQL}) AS valid FROM orders),
            r AS (SELECT *, CASE WHEN NOT valid THEN 'invalid' WHEN org_unit_id IS NULL THEN 'bad_org_unit' END AS reason FROM s)
       SELECT o_orderkey, CASE WHEN reason IS NULL THEN 'imported' ELSE 'ignored' END AS outcome, reason,
              CASE WHEN reason IS NULL THEN uuid END AS instance_uuid,
              CASE WHEN reason IS NULL THEN '<data {_NS_SQL}' || chr(10) || '      id="{FORM_ID}" version="{LATEST_VERSION}">' || chr(10)
                   || '    <grp>' || chr(10) || {_ORDER_FIELDS_SQL} || '    </grp>' || chr(10) || '    <meta>' || chr(10)
                   || '        <instanceID>uuid:' || uuid || '</instanceID>' || chr(10) || '    </meta>' || chr(10) || '</data>' END AS document,
              CASE WHEN reason IS NULL THEN '{{"id":"' || uuid || '","orgUnitId":' || org_unit_id || ',"created_at":{RUN_EPOCH},"formId":{FORM_ID},'
                   || '"accuracy":0,"altitude":0,"latitude":' || CAST(latitude AS VARCHAR) || ',"longitude":null,'
                   || '"file":"outbox/creates/' || uuid || '.xml","name":"' || uuid || '.xml"}}' END AS payload
       FROM r""",
)
def q_create_outbox(spark, sf_dir):
    """K4 (+ V2, V4, F9, F11, F13, F14, P10, P11): outbox of a CREATE import."""
    o = table(spark, sf_dir, "orders")
    subs = o.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") < 20000, F.lit(None)).otherwise(F.col("o_custkey")).alias("org_unit_id"),
        "o_orderstatus", "o_orderpriority", "o_totalprice", F.round(F.col("o_totalprice") / 10000, 2).alias("latitude"),
    )
    out = create_outbox(subs, order_rules(spark), FORM_ID, latest_version_id=LATEST_VERSION, created_at=RUN_EPOCH,
                        directory="outbox/creates", key_cols=["o_orderkey"], keep=["o_orderkey"])
    return out.select("o_orderkey", "outcome", "reason", "instance_uuid", "document", "payload")


@register(
    "update_outbox",
    f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN 'n' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END AS id,
                          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE md5(CAST(o_orderkey AS VARCHAR)) END AS uuid,
                          CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS org_unit_id,
                          o_orderstatus, o_orderpriority, o_totalprice,
                          ({_ORDER_VALID_SQL}) AND ({_ORDER_CHOICES_SQL}) AS valid FROM orders),
            r AS (SELECT *, CASE WHEN NOT valid THEN 'invalid' WHEN uuid IS NULL THEN 'missing_instance_id'
                                 WHEN NOT regexp_matches(id, '^[0-9]+$') THEN 'bad_id' WHEN o_orderkey % 7 = 0 THEN 'locked' END AS reason FROM s)
       SELECT o_orderkey, CASE WHEN reason IS NULL THEN 'updated' ELSE 'ignored' END AS outcome, reason,
              CASE WHEN regexp_matches(id, '^[0-9]+$') THEN CAST(id AS BIGINT) END AS instance_id,
              CASE WHEN reason IS NULL THEN '<?xml version="1.0" encoding="utf-8"?>' || chr(10) || '<data {_NS_SQL} id="{FORM_ID}" version="{LATEST_VERSION}" instance="'
                   || id || '">' || chr(10) || '    <grp>' || chr(10) || {_ORDER_FIELDS_SQL} || '    </grp>' || chr(10) || '    <meta>' || chr(10)
                   || '        <instanceID>uuid:' || uuid || '</instanceID>' || chr(10) || '    <editUserID>{EDITOR}</editUserID></meta>' || chr(10) || '</data>' END AS document,
              CASE WHEN reason IS NULL AND COALESCE(org_unit_id <> 0, false)
                   THEN '{{"org_unit":"' || org_unit_id || '","formID":{FORM_ID},"accuracy":0,"altitude":0,"latitude":null,"longitude":null}}' END AS payload,
              reason IS NULL AND COALESCE(org_unit_id <> 0, false) AS patch_org_unit
       FROM r""",
)
def q_update_outbox(spark, sf_dir):
    """K5 (+ J6 lock lookup, F10 enrichment, F11, F14): outbox of an UPDATE import."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    subs = o.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 450000, F.concat(F.lit("n"), key)).otherwise(key).alias("id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None)).otherwise(F.concat(F.lit("uuid:"), F.md5(key))).alias("instanceID"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey")).alias("org_unit_id"),
        "o_orderstatus", "o_orderpriority", "o_totalprice",
    )
    out = update_outbox(subs, order_rules(spark), FORM_ID, instances=_instances(spark, sf_dir), editor=EDITOR,
                        latest_version_id=LATEST_VERSION, keep=["o_orderkey"])
    return out.select("o_orderkey", "outcome", "reason", "instance_id", "document", "payload", "patch_org_unit")


@register(
    "delete_outbox",
    """WITH s AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'x' || o_orderkey
                                                     WHEN '2-HIGH' THEN ' ' || o_orderkey || ' '
                                                     WHEN '3-MEDIUM' THEN o_orderkey || '.5'
                                                     WHEN '5-LOW' THEN NULL
                                                     ELSE CAST(o_orderkey AS VARCHAR) END AS id FROM orders)
       SELECT o_orderkey,
              CASE WHEN id IS NOT NULL AND regexp_matches(id, '^ *[0-9]+ *$') THEN 'deleted' ELSE 'ignored' END AS outcome,
              CASE WHEN id IS NULL THEN 'missing_id' WHEN NOT regexp_matches(id, '^ *[0-9]+ *$') THEN 'bad_id' END AS reason,
              CASE WHEN regexp_matches(id, '^ *[0-9]+ *$') THEN CAST(trim(id) AS BIGINT) END AS instance_id
       FROM s""",
)
def q_delete_outbox(spark, sf_dir):
    """K6 + F13: integer ids like Python ``int`` on text; others ignored."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    p = F.col("o_orderpriority")
    subs = o.select(
        "o_orderkey",
        F.when(p == "1-URGENT", F.concat(F.lit("x"), key)).when(p == "2-HIGH", F.concat(F.lit(" "), key, F.lit(" ")))
        .when(p == "3-MEDIUM", F.concat(key, F.lit(".5"))).when(p == "5-LOW", F.lit(None)).otherwise(key).alias("id"),
    )
    return delete_outbox(subs, keep=["o_orderkey"])


@register(
    "import_summary",
    f"""WITH s AS (SELECT CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderkey END AS id,
                          CASE WHEN o_totalprice < 20000 THEN NULL ELSE o_custkey END AS org, o_orderkey, o_orderpriority,
                          ({_ORDER_VALID_SQL}) AND ({_ORDER_CHOICES_SQL}) AS valid FROM orders),
            r AS (SELECT *, CASE WHEN id IS NULL AND org IS NOT NULL THEN 'create' WHEN id IS NOT NULL THEN 'update' ELSE 'unrouted' END AS route FROM s),
            o AS (SELECT CASE WHEN route = 'create' THEN CASE WHEN valid THEN 'imported' ELSE 'ignored' END
                              WHEN route = 'update' THEN CASE WHEN valid AND o_orderpriority <> '4-NOT SPECIFIED' AND o_orderkey % 7 <> 0
                                                              THEN 'updated' ELSE 'ignored' END
                              ELSE 'unrouted' END AS outcome FROM r)
       SELECT count(*) FILTER (WHERE outcome = 'imported') AS imported, count(*) FILTER (WHERE outcome = 'updated') AS updated,
              count(*) FILTER (WHERE outcome = 'ignored') AS ignored, count(*) FILTER (WHERE outcome = 'deleted') AS deleted,
              count(*) FILTER (WHERE outcome = 'unrouted') AS unrouted
       FROM o""",
)
def q_import_summary(spark, sf_dir):
    """K7 + A3: CREATE_AND_UPDATE routed in one pass, then the outcome counts."""
    outbox = route_import(_combined_submissions(spark, sf_dir), "CREATE_AND_UPDATE", order_rules(spark), FORM_ID,
                          instances=_instances(spark, sf_dir), editor=EDITOR, latest_version_id=LATEST_VERSION,
                          created_at=RUN_EPOCH, key_cols=["o_orderkey"])
    return outcome_summary(outbox)


# ---------------------------------------------------------------------------
# Text, sinks and sources
# ---------------------------------------------------------------------------


@register(
    "flatten_text",
    """SELECT event_id, CAST(ts AS VARCHAR) AS ts, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(value > 100 AS INTEGER) AS big,
              CAST(to_json(string_split(event_type, 'i')) AS VARCHAR) AS parts,
              CAST(to_json({'user_id': user_id, 'event_type': event_type}) AS VARCHAR) AS who
       FROM events""",
)
def q_flatten_text(spark, sf_dir):
    """temporal -> text, boolean -> 0/1, list and struct -> JSON text."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("ts").cast("date").alias("day"), (F.col("value") > 100).alias("big"),
        F.split("event_type", "i").alias("parts"), F.struct("user_id", "event_type").alias("who"),
    )
    return flatten_for_text(ev)


@register(
    "strip_strings",
    f"""SELECT doc_id, {_strip_sql("' ' || chr(9) || chr(10) || text || ' ' || chr(12288) || ' '")} AS text,
               {_strip_sql("chr(133) || lang || ' '")} AS lang, n_chars
        FROM documents""",
)
def q_strip_strings(spark, sf_dir):
    """Unicode whitespace trimmed at both ends of every text column."""
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit(" \t\n"), "text", F.lit(" 　 ")).alias("text"), F.concat(F.lit("\u0085"), "lang", F.lit(" ")).alias("lang"), "n_chars",
    )
    return strip_strings(d)


ORDER_COLUMNS_SQL = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("table_drift", f"SELECT {ORDER_COLUMNS_SQL} FROM orders")
def q_table_drift(spark, sf_dir):
    """S6 + V5 + K2's by-name alignment: a frame with the table's columns in another
    order passes the guard and is aligned to the table's order."""
    orders = table(spark, sf_dir, "orders")
    orders.createOrReplaceTempView("formwork_drift_target")
    incoming = orders.select(*reversed(orders.columns))
    check_table_schema(spark, incoming, "formwork_drift_target")
    return incoming.select(*table_columns(spark, "formwork_drift_target"))


@register("snapshot", "SELECT 1 AS number, 'v1' AS name, count(*) AS rows FROM orders")
def q_snapshot(spark, sf_dir):
    """K3 + A7 + K1: the same content written twice gives one version."""
    root = scratch_path(spark, "snapshot")
    orders = table(spark, sf_dir, "orders")
    snapshot_if_changed(spark, orders, root)
    snapshot_if_changed(spark, orders.select(*reversed(orders.columns)).repartition(3), root)
    return spark.read.parquet(f"{root}/{MANIFEST}").select("number", "name", "rows")


@register(
    "snapshot_changes",
    """SELECT v.number, 'v' || v.number AS name, count(*) AS rows FROM orders, (VALUES (1), (2), (3), (4), (5), (6), (7)) v(number)
       GROUP BY v.number""",
)
def q_snapshot_changes(spark, sf_dir):
    """K3 + A7: a null that moves to another column, a renamed column, a retyped one and
    regrouped lists each give a new version, and so does a nested time that moves by a
    microsecond; the same content again gives none."""
    root = scratch_path(spark, "snapshot-changes")
    orders = table(spark, sf_dir, "orders")
    a, b = F.col("o_orderstatus"), F.lit(None).cast("string")
    pair = lambda x, y: orders.select("o_orderkey", x.alias("a"), y.alias("b"))
    lists = lambda *groups: orders.select("o_orderkey", F.array(*groups).alias("a"))
    key = F.col("o_orderkey")
    time = lambda micros: F.timestamp_micros(key * 1000 + micros)
    for content in (
        pair(a, b), pair(a, b).repartition(3), pair(b, a), pair(b, a).withColumnRenamed("a", "c"),
        lists(F.array(key), F.array(key)), lists(F.array(key, key)), lists(F.array(key, key)),
        lists(time(1)), lists(time(2)), lists(time(2)),
    ):
        snapshot_if_changed(spark, content, root)
    return spark.read.parquet(f"{root}/{MANIFEST}").select("number", "name", "rows")


@register("table_appends", "SELECT o_orderkey, o_orderstatus, CAST(o_orderstatus AS VARCHAR) AS run FROM orders WHERE o_orderstatus IN ('F', 'O') UNION ALL SELECT o_orderkey, NULL, 'late' FROM orders WHERE o_orderstatus = 'P'")
def q_table_appends(spark, sf_dir):
    """K2 + V5: runs appended to a table, each of them twice (a retry), the last with
    fewer columns, and one that is refused; read back from the table."""
    name = f"formwork_appends_{uuid.uuid4().hex[:12]}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for run in ("F", "F", "O", "O"):
        append_once(spark, orders.where(F.col("o_orderstatus") == run), name, run)
    for _ in range(2):
        append_once(spark, orders.where("o_orderstatus = 'P'").select("o_orderkey"), name, "late")
    try:
        append_once(spark, orders.withColumn("extra", F.lit(1)), name, "refused")
    except ValueError:
        pass  # V5: the table has no such column
    return spark.table(name)


_CSV_TEXT = """CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('  "', text, '", \\ ') ELSE text END"""


@register("csv_round_trip", f"SELECT n_chars, {_CSV_TEXT} AS text, doc_id FROM documents")
def q_csv_round_trip(spark, sf_dir):
    """K1 then S1: whole texts with quotes, line breaks, outer blanks, empty and null,
    written as CSV and read back by header name, the columns in another order."""
    path = scratch_path(spark, "texts") + ".csv"
    docs = table(spark, sf_dir, "documents")
    write_file(docs.select("doc_id", F.expr(_CSV_TEXT.replace("\\", "\\\\")).alias("text"), "n_chars"), path, "csv")
    return read_submissions(spark, path, "n_chars bigint, text string, doc_id bigint")


@register(
    "chained_calculates",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) + 1 AS a, (CAST(l_quantity AS BIGINT) + 1) * 2 AS b,
              CAST(0 AS BIGINT) AS c, (CAST(l_quantity AS BIGINT) + 1) * 2 <= 60 AS ok FROM lineitem""",
)
def q_chained_calculates(spark, sf_dir):
    """V2 + F5: formulas that use earlier calculated fields, a rejected one (0), and a
    constraint on a calculated field."""
    rules = rules_from_rows([
        {"name": "l_quantity", "type": "integer"}, {"name": "a", "type": "calculate", "calculation": "round(${l_quantity}) + 1"},
        {"name": "b", "type": "calculate", "calculation": "${a} * 2", "constraint": ".<=60"}, {"name": "c", "type": "calculate", "calculation": "if(${a})"},
    ])
    out = validate_rows(table(spark, sf_dir, "lineitem"), rules)
    return out.select("l_orderkey", "l_linenumber", "a", "b", "c", F.col("constraints_validation_summary").alias("ok"))


@register(
    "equal_rows_outbox",
    """SELECT o_orderstatus AS status, 'imported' AS outcome, count(*) AS n_rows, count(*) AS n_ids FROM orders GROUP BY o_orderstatus""",
)
def q_equal_rows_outbox(spark, sf_dir):
    """K4 + F11 without key columns: very many equal rows, each with an id of its own."""
    rows = table(spark, sf_dir, "orders").select(F.lit(1).cast("bigint").alias("org_unit_id"), F.col("o_orderstatus").alias("status"))
    out = create_outbox(rows, rules_from_rows([{"name": "status", "type": "text"}]), 1, created_at=RUN_EPOCH, keep=["status"])
    return out.groupBy("status", "outcome").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("instance_uuid").alias("n_ids"))


@register(
    "versioned_outcomes",
    """SELECT o_orderkey, CASE WHEN reason IS NULL THEN 'imported' ELSE 'ignored' END AS outcome, reason FROM (
         SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 'no_template'
                WHEN 1 + o_orderkey % 6 > CASE WHEN o_orderkey % 4 = 2 THEN 3 ELSE 4 END THEN 'invalid'
                WHEN o_orderkey % 5 = 0 THEN 'bad_number' END AS reason FROM orders)""",
)
def q_versioned_outcomes(spark, sf_dir):
    """K4 + V3 + F13: versions with their own calculated field and constraint, a version
    without definition, and coordinates that are no numbers or blank."""
    key = F.col("o_orderkey")
    rules = {
        v: rules_from_rows([{"name": "x", "type": "integer"}, {"name": "a", "type": "calculate", "calculation": "${x} + 1", "constraint": f".<={limit}"}])
        for v, limit in (("0", 4), ("1", 4), ("2", 3))
    }
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (key % 6).cast("string").alias("x"), (key % 4).cast("string").alias("form_version"), key.alias("org_unit_id"),
        F.when(key % 5 == 0, "abc").when(key % 5 == 1, " ").otherwise("1.5").alias("latitude"),
    )
    return create_outbox(rows, None, 1, rules_by_version=rules, created_at=RUN_EPOCH, keep=["o_orderkey"]).select("o_orderkey", "outcome", "reason")


@register("read_files", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_read_files(spark, sf_dir):
    """K1 then S1: customers written as CSV and read back by suffix with a schema."""
    cust = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customers") + ".csv"
    write_file(cust, path, "csv")
    return read_submissions(spark, path, schema=cust.schema)


@register(
    "org_units_from_csv",
    f"""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS org_unit_type,
               {_ORG_BASE_SQL} AS opening_date,
               CAST({_ORG_BASE_SQL} AS TIMESTAMP) + to_hours(CAST(c_custkey % 24 AS BIGINT)) + to_minutes(CAST(c_custkey % 60 AS BIGINT)) AS created_at,
               CAST(r_regionkey AS VARCHAR) AS level_1_ref, n_name AS level_2_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_mktsegment = 'BUILDING'""",
)
def q_org_units_from_csv(spark, sf_dir):
    """K1 then S3 + P1 + P2: the org-unit export as CSV text, read back for one type."""
    path = scratch_path(spark, "orgunits") + ".csv"
    write_file(_org_unit_export(spark, sf_dir), path, "csv")
    units = project_org_units(read_org_units(spark, path, type_name="BUILDING"))
    return units.select("id", "name", "org_unit_type", "opening_date", "created_at", "level_1_ref", "level_2_name")


@register("sheet_sort", "SELECT c_acctbal, c_custkey, c_mktsegment, c_name, c_nationkey FROM customer")
def q_sheet_sort(spark, sf_dir):
    """O3: columns alphabetical, rows by the original column order."""
    return sheet_sort(table(spark, sf_dir, "customer"))
