"""Org-unit operators: projection of the export headings (P1), hierarchy levels (P2),
type filter (P6) and geometry lookup (J2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formwork.functions.coerce import parse_dates
from formwork.operators.columns import q
from formwork.operators.lookup import left_lookup

# Headings of the org-unit export and their output names.
HEADINGS = [
    ("ID", "id", None),
    ("Nom", "name", None),
    ("Type", "org_unit_type", None),
    ("Latitude", "latitude", None),
    ("Longitude", "longitude", None),
    ("Date d'ouverture", "opening_date", "date"),
    ("Date de fermeture", "closing_date", "date"),
    ("Date de création", "created_at", "datetime"),
    ("Date de modification", "updated_at", "datetime"),
    ("Source", "source", None),
    ("Validé", "validation_status", None),
    ("Référence externe", "source_ref", None),
]
LEVEL_REF_HEADING = "Ref Ext parent {n}"
LEVEL_NAME_HEADING = "parent {n}"
MAX_LEVEL = 9


def project_levels(raw: DataFrame, max_level: int = MAX_LEVEL) -> list[Column]:
    """``level_n_ref`` for every present ``Ref Ext parent n``, then ``level_n_name``
    for every present ``parent n``, n = 1..max_level."""
    cols = set(raw.columns)
    refs = [q(LEVEL_REF_HEADING.format(n=n)).alias(f"level_{n}_ref") for n in range(1, max_level + 1) if LEVEL_REF_HEADING.format(n=n) in cols]
    names = [q(LEVEL_NAME_HEADING.format(n=n)).alias(f"level_{n}_name") for n in range(1, max_level + 1) if LEVEL_NAME_HEADING.format(n=n) in cols]
    return refs + names


def project_org_units(raw: DataFrame, strict: bool = True) -> DataFrame:
    """P1 + P2 + F2: rename the headings, parse the two dates and two datetimes, add
    the hierarchy levels. Strict parsing raises on bad text."""
    base = []
    for heading, name, kind in HEADINGS:
        c = q(heading)
        base.append((parse_dates(c, kind, strict) if kind else c).alias(name))
    return raw.select(*base, *project_levels(raw))


def org_unit_type_name(types: DataFrame, type_id: int) -> str:
    """Name of a type id; raises when the id is unknown. Fetches at most two rows."""
    found = types.where(F.col("id") == F.lit(type_id)).select("name").limit(2).collect()
    if not found:
        raise ValueError(f"no organisation unit type with id {type_id}")
    return found[0]["name"]


def filter_org_unit_type(units: DataFrame, types: DataFrame, type_id: int | None, type_col: str = "org_unit_type") -> DataFrame:
    """With a type id, look the type up (raise when absent) and keep the units of
    that type; without one keep all units."""
    if type_id is None:
        return units
    return units.where(q(type_col) == F.lit(org_unit_type_name(types, type_id)))


def attach_geometry(units: DataFrame, geometries: DataFrame, id_col: str = "id", geometry_col: str = "geometry") -> DataFrame:
    """Left lookup of each unit's GeoJSON text; units without one get null.

    The lookup holds one value per id (like a dictionary): duplicates are reduced to
    the greatest text by a map-side-combined aggregate, whose hash partitioning on the
    id is reused by the join, so only the units side is shuffled (or neither, when AQE
    finds the lookup small enough to broadcast)."""
    lookup = geometries.groupBy(q(id_col).alias("_gid")).agg(F.max(q(geometry_col)).alias(geometry_col))
    base = units.drop(geometry_col) if geometry_col in units.columns else units
    return left_lookup(base, q(id_col), lookup, "_gid")
