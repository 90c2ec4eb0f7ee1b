"""Schema-level operators: name cleaning and de-duplication (P4), canonical column
order (P3), list-column drop (P5), sorts (O1-O4) and column set differences (U1).

All of these decide on the driver from ``df.columns`` / ``df.schema`` and then emit one
projection or sort; no rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from formwork.operators.order import numbered

from formwork.functions.text import clean_name


def q(name: str) -> Column:
    """Column by exact name (back-quoted, so dots and spaces are literal)."""
    return F.col("`" + name.replace("`", "``") + "`")


def dedupe_names(names: list[str]) -> list[str]:
    """P4 naming rule: clean every name; a cleaned name that occurs more than once gets
    ``_1``, ``_2``... in column order. Suffixes already taken by another column are
    skipped (D-1), so the result is always unique."""
    cleaned = [clean_name(n) for n in names]
    counts: dict[str, int] = {}
    for c in cleaned:
        counts[c] = counts.get(c, 0) + 1
    taken = {c for c in cleaned if counts[c] == 1}
    next_suffix: dict[str, int] = {}
    out = []
    for c in cleaned:
        if counts[c] == 1:
            out.append(c)
            continue
        k = next_suffix.get(c, 1)
        while f"{c}_{k}" in taken:
            k += 1
        name = f"{c}_{k}"
        taken.add(name)
        next_suffix[c] = k + 1
        out.append(name)
    return out


def clean_column_names(df: DataFrame) -> DataFrame:
    """Positional rename; works on frames whose names repeat."""
    return df.toDF(*dedupe_names(df.columns))


def canonical_columns(df: DataFrame) -> DataFrame:
    """Columns in alphabetical (code point) order."""
    return df.select(*[q(c) for c in sorted(df.columns)])


def _ordered(df: DataFrame, keys: list[Column], position: str | None) -> DataFrame:
    """The frame sorted, or, when ``position`` names a column, with each row's place in
    that order (which survives storage that keeps no order)."""
    return numbered(df, keys, position) if position else df.sort(*keys)


def canonical_sort(df: DataFrame, by: list[str] | None = None, position: str | None = None) -> DataFrame:
    """O1: total ascending sort, nulls first, over ``by`` (default: all columns in order).

    A global sort is a range-partitioned shuffle; use it only for canonical output."""
    return _ordered(df, [q(c).asc_nulls_first() for c in (by or df.columns)], position)


def list_columns(df: DataFrame) -> list[str]:
    """Columns of type ``array<string>`` (the multi-select answers)."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType)
    ]


def drop_list_columns(df: DataFrame, id_col: str = "instanceid") -> DataFrame:
    """P5: drop the list columns and move ``id_col`` last; ``id_col`` must exist."""
    if id_col not in df.columns:
        raise ValueError(f"column {id_col!r} is required and missing")
    drop = set(list_columns(df))
    keep = [c for c in df.columns if c not in drop and c != id_col]
    return df.select(*[q(c) for c in keep], q(id_col))


def sort_by_label(df: DataFrame, label: str = "label", tie_break: tuple[str, ...] = ("name", "choice_value"), position: str | None = None) -> DataFrame:
    """O2: sort by label; the reference leaves ties unordered, we break them by name
    and choice value so output is deterministic."""
    keys = [label] + [c for c in tie_break if c in df.columns]
    return _ordered(df, [q(c).asc_nulls_first() for c in keys], position)


def sheet_sort(df: DataFrame, position: str | None = None) -> DataFrame:
    """O3: columns alphabetical, rows sorted by the original column order."""
    original = list(df.columns)
    return _ordered(df.select(*[q(c) for c in sorted(original)]), [q(c).asc_nulls_first() for c in original], position)


def geo_sort(df: DataFrame, geometry_col: str = "geometry", position: str | None = None) -> DataFrame:
    """Sort over all columns ascending with nulls last (pandas default); the
    geometry is compared as its GeoJSON text."""
    keys = []
    for f in df.schema.fields:
        c = q(f.name)
        if f.name == geometry_col and not isinstance(f.dataType, StringType):
            c = F.to_json(c)
        keys.append(c.asc_nulls_last())
    return _ordered(df, keys, position)


def column_diff(present: list[str], required: set[str], expected: set[str] | None = None) -> tuple[set[str], set[str]]:
    """(missing, unexpected) = (required - present, present - expected)."""
    cols = set(present)
    return required - cols, cols - (expected if expected is not None else required)


def question_fields(df: DataFrame, question_names: list[str] | set[str]) -> list[str]:
    """P10: submission columns that are also question names, in submission order."""
    names = set(question_names)
    return [c for c in df.columns if c in names]
