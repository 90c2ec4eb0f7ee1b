"""Geometry operators on decoded geometries (see ``functions.geometry``): ring/vertex
rows (F7), GeoJSON features (F8), shared boundary segments and merged arcs (K9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from formwork.functions.geometry import ENVELOPE, MULTIPOLYGON, POINT, POLYGONS_TYPE, assemble_geometry, compat_polygons, geometry_json
from formwork.operators.columns import q
from formwork.session import scratch_path


def decode_geometries(df: DataFrame, source: str | Column = "geometry", target: str = "geometry", compat_target: str | None = None) -> DataFrame:
    """F6 over a frame: GeoJSON text in ``source`` decoded into ``target`` (and, when
    asked, the reference's multipolygon shape into ``compat_target``).

    The document is parsed once into (type, raw coordinates), then the coordinates once
    into the type's array shape, each in its own projection, so every parse runs once
    per row; Catalyst keeps the stages because each is used more than once."""
    g = q(source) if isinstance(source, str) else source
    outputs = {target} | ({compat_target} if compat_target else set())
    staged = df.select("*", F.from_json(g, ENVELOPE).alias("__geo"))
    kind, coords = F.col("__geo.type"), F.col("__geo.coordinates")
    staged = staged.select(
        "*",
        F.when(kind == POINT, F.from_json(coords, "array<double>")).alias("__geo_pt"),
        F.when(kind == MULTIPOLYGON, F.from_json(coords, POLYGONS_TYPE)).alias("__geo_mp"),
    )
    pt, mp = F.col("__geo_pt"), F.col("__geo_mp")
    decoded = [assemble_geometry(kind, pt, mp).alias(target)]
    if compat_target:
        decoded.append(assemble_geometry(kind, pt, compat_polygons(mp)).alias(compat_target))
    return staged.select(*[q(c) for c in df.columns if c not in outputs], *decoded)


def polygon_rings(df: DataFrame, id_col: str = "id", geometry_col: str = "geometry", level: str = "vertex") -> DataFrame:
    """polygons of a decoded multipolygon as rows.

    ``level='ring'`` gives (id, polygon, ring, n_vertices); ``level='vertex'`` gives
    (id, polygon, ring, vertex, x, y). Positions start at 0; ring 0 is the shell."""
    polys = df.select(q(id_col).alias(id_col), F.posexplode(q(geometry_col)["polygons"]).alias("polygon", "_p"))
    rings = polys.select(id_col, "polygon", F.posexplode("_p").alias("ring", "_r"))
    if level == "ring":
        return rings.select(id_col, "polygon", "ring", F.size("_r").alias("n_vertices"))
    verts = rings.select(id_col, "polygon", "ring", F.posexplode("_r").alias("vertex", "_v"))
    return verts.select(id_col, "polygon", "ring", "vertex", F.element_at("_v", 1).alias("x"), F.element_at("_v", 2).alias("y"))


def geojson_feature(df: DataFrame, geometry_col: str = "geometry") -> DataFrame:
    """F8: one GeoJSON Feature text per row (column ``feature``); the geometry comes
    from the decoded struct, the other columns become properties with temporal values
    as text."""
    props = []
    for f in df.schema.fields:
        if f.name == geometry_col:
            continue
        c = q(f.name)
        if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = c.cast("string")
        props.append(c.alias(f.name))
    geom = q(geometry_col)
    geom_text = geometry_json(geom) if isinstance(df.schema[geometry_col].dataType, StructType) else geom
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.parse_json(F.coalesce(geom_text, F.lit("null"))).alias("geometry"),
            F.struct(*props).alias("properties"),
        ),
        {"ignoreNullFields": "false"},
    )
    return df.select(feature.alias("feature"))


def _unit_segments(df: DataFrame, id_col: str, geometry_col: str) -> DataFrame:
    """Every undirected segment (p, r) of every unit's rings, once per unit (_id). The end
    points are in order, so a border walked either way gives one segment."""
    rings = df.select(q(id_col).alias("_id"), F.explode(F.flatten(q(geometry_col)["polygons"])).alias("_r"))
    segs = rings.select(
        "_id",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("_r") - 1, F.lit(1))),
                lambda i: F.struct(F.element_at("_r", i).alias("a"), F.element_at("_r", i + 1).alias("b")),
            )
        ).alias("_s"),
    ).where(F.col("_s.b").isNotNull())
    a = F.struct(F.element_at("_s.a", 1).alias("x"), F.element_at("_s.a", 2).alias("y"))
    b = F.struct(F.element_at("_s.b", 1).alias("x"), F.element_at("_s.b", 2).alias("y"))
    keyed = segs.select("_id", F.least(a, b).alias("p"), F.greatest(a, b).alias("r")).where(F.col("p") != F.col("r"))
    return keyed.groupBy("p", "r", "_id").agg(F.lit(1).alias("_"))


def shared_arcs(df: DataFrame, id_col: str = "id", geometry_col: str = "geometry") -> DataFrame:
    """K9: boundary topology as a table of undirected segments, each stored once.

    Per segment: ``n_units`` distinct units using it, the lowest and highest unit id. A
    segment with ``n_units > 1`` is a shared border. Both aggregates combine map-side
    first."""
    return _unit_segments(df, id_col, geometry_col).groupBy("p", "r").agg(
        F.count("*").alias("n_units"), F.min("_id").alias("unit_min"), F.max("_id").alias("unit_max")
    ).select(
        F.col("p.x").alias("x1"), F.col("p.y").alias("y1"), F.col("r.x").alias("x2"), F.col("r.y").alias("y2"),
        "n_units", "unit_min", "unit_max",
    )


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _jump(steps: DataFrame) -> DataFrame:
    """One round of pointer jumping: open steps take over where their pointer leads."""
    ahead = steps.select(F.col("u").alias("_u"), F.col("v").alias("_v"), F.col("to").alias("_to"), F.col("far").alias("_far"), F.col("open").alias("_open"), F.col("low").alias("_low"))
    moved = steps.where("open").join(ahead, (F.col("to.u") == F.col("_u")) & (F.col("to.v") == F.col("_v")))
    moved = moved.select("u", "v", "units", F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"), F.col("_open").alias("open"), F.least("low", "_low").alias("low"))
    return _written(steps.where("not open").unionByName(moved), "arc-steps")


def _jumped(steps: DataFrame) -> DataFrame:
    """Pointer jumping until every step that has an end has found it: of a chain some
    steps find it in each round, so when none does, the open ones go round in loops."""
    left = steps.where("open").count()
    while left:
        steps, before = _jump(steps), left
        left = steps.where("open").count()
        if left == before:
            break
    return steps


def merged_arcs(df: DataFrame, id_col: str = "id", geometry_col: str = "geometry") -> DataFrame:
    """K9: the boundary topology as arcs, each border between the same units stored once
    as an ordered list of vertices.

    A vertex is a junction where other than two segments meet or the set of units using
    them changes; an arc runs from junction to junction, and a ring without any starts
    at its smallest vertex. Steps along the segments, in both directions, are ranked by
    pointer jumping (rounds are the logarithm of the longest arc, no task follows a
    chain); of the two directions the one whose vertex list is smaller is kept.

    Gives ``vertices`` (array of x, y), ``units`` (their ids in order) and ``n_units``."""
    segments = _unit_segments(df, id_col, geometry_col).groupBy("p", "r").agg(F.array_sort(F.collect_set("_id")).alias("units"))
    segments = _written(segments, "arc-segments")
    both = segments.select(F.col("p").alias("u"), F.col("r").alias("v"), "units").unionByName(segments.select(F.col("r").alias("u"), F.col("p").alias("v"), "units"))
    met = both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("units").alias("a"), F.max("units").alias("b"), F.min("v").alias("low"), F.max("v").alias("high"))
    passed = met.where((F.col("n") == 2) & (F.col("a") == F.col("b"))).select(F.col("u").alias("via"), F.col("low").alias("one"), F.col("high").alias("other"))
    steps = both.join(passed, F.col("v") == F.col("via"), "left")
    beyond = F.when(F.col("one") == F.col("u"), F.col("other")).otherwise(F.col("one"))
    own = F.struct("u", "v")
    steps = _written(steps.select(
        "u", "v", "units",
        F.when(F.col("via").isNotNull(), F.struct(F.col("v").alias("u"), beyond.alias("v"))).otherwise(own).alias("to"),
        F.when(F.col("via").isNotNull(), 1).otherwise(0).cast("long").alias("far"),
        F.col("via").isNotNull().alias("open"),
        F.col("u").alias("low"),
    ), "arc-steps")
    ranked = _jumped(steps)
    loops = ranked.where("open")
    if not loops.isEmpty():
        ranked = ranked.where("not open").unionByName(_jumped(_broken(loops, steps)))
    path = F.array_sort(F.collect_list(F.struct((-F.col("far")).alias("at"), F.col("u").alias("vertex"))))
    arcs = ranked.groupBy("to").agg(path.alias("path"), F.first("units").alias("units"))
    vertices = F.concat(F.transform("path", lambda s: s["vertex"]), F.array(F.col("to.v")))
    arcs = arcs.select(vertices.alias("vertices"), "units", F.size("units").alias("n_units"))
    return arcs.where(F.col("vertices") <= F.reverse("vertices"))


def _broken(loops: DataFrame, steps: DataFrame) -> DataFrame:
    """The steps of rings without a junction, ending at the smallest vertex of the ring.
    Their smallest vertex is known once another round changes none."""
    while True:
        further = _jump(loops)
        old = loops.select("u", "v", F.col("low").alias("_old"))
        settled = further.join(old, ["u", "v"]).where(F.col("low") != F.col("_old")).isEmpty()
        loops = further
        if settled:
            break
    lows = loops.select("u", "v", F.col("low").alias("_low"))
    fresh = steps.drop("low").join(lows, ["u", "v"])
    end = F.col("v") == F.col("_low")
    return _written(fresh.select(
        "u", "v", "units", F.when(end, F.struct("u", "v")).otherwise(F.col("to")).alias("to"),
        F.when(end, 0).otherwise(F.col("far")).cast("long").alias("far"), (~end).alias("open"), F.col("_low").alias("low"),
    ), "arc-steps")
