"""GeoJSON decoding (F6) as native expressions.

A decoded geometry is ``struct<kind, lon, lat, polygons>``: ``kind`` is ``Point`` or
``MultiPolygon``; points fill ``lon``/``lat`` (first two coordinates), multipolygons
fill ``polygons`` as array(polygon) of array(ring) of array(vertex) of array(double).
Other types, bad JSON and missing keys give null (D-13).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "Point"
MULTIPOLYGON = "MultiPolygon"
POLYGONS_TYPE = "array<array<array<array<double>>>>"


# Schema of a GeoJSON geometry with the coordinates kept as raw JSON text.
ENVELOPE = "struct<type: string, coordinates: string>"


def compat_polygons(polys: Column) -> Column:
    """D-12 shape: only the first polygon, each of its rings turned into a polygon."""
    return F.transform(F.element_at(polys, 1), lambda ring: F.array(ring))


def assemble_geometry(kind: Column, point: Column, polys: Column) -> Column:
    """The decoded struct from the type and the parsed coordinates (null if invalid)."""
    lon, lat = F.element_at(point, 1), F.element_at(point, 2)
    valid = ((kind == POINT) & (F.size(point) >= 2) & lon.isNotNull() & lat.isNotNull()) | ((kind == MULTIPOLYGON) & polys.isNotNull())
    return F.when(
        valid,
        F.struct(kind.alias("kind"), F.when(kind == POINT, lon).alias("lon"), F.when(kind == POINT, lat).alias("lat"),
                 F.when(kind == MULTIPOLYGON, polys).alias("polygons")),
    )


def decode_geometry(geojson: Column | str, compat: bool = False) -> Column:
    """F6 as one column expression. ``compat=True`` keeps the reference's shape for
    multipolygons (D-12). Inside conditional branches Catalyst may evaluate a parse more
    than once per row; ``operators.geo.decode_geometries`` stages the parses in their
    own projections and is the faster form for whole frames."""
    g = F.col(geojson) if isinstance(geojson, str) else geojson
    env = F.from_json(g, ENVELOPE)
    kind, coords = env["type"], env["coordinates"]
    point = F.when(kind == POINT, F.from_json(coords, "array<double>"))
    polys = F.when(kind == MULTIPOLYGON, F.from_json(coords, POLYGONS_TYPE))
    return assemble_geometry(kind, point, compat_polygons(polys) if compat else polys)


def geometry_json(decoded: Column | str) -> Column:
    """GeoJSON text of a decoded geometry (the inverse of ``decode_geometry``)."""
    d = F.col(decoded) if isinstance(decoded, str) else decoded
    point = F.to_json(F.struct(F.lit(POINT).alias("type"), F.array(d["lon"], d["lat"]).alias("coordinates")))
    multi = F.to_json(F.struct(F.lit(MULTIPOLYGON).alias("type"), d["polygons"].alias("coordinates")))
    return F.when(d["kind"] == POINT, point).when(d["kind"] == MULTIPOLYGON, multi)
