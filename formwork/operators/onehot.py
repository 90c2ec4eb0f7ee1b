"""Multi-select flattening: distinct categories (A2) and 0/1 flag columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formwork.functions.text import clean_name
from formwork.operators.columns import canonical_columns, canonical_sort, drop_list_columns, list_columns, q
from formwork.operators.order import numbered
from formwork.session import scratch_path


def distinct_values(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """A2: distinct non-null elements of each list column, in one job for all columns.

    The lists are exploded to (column index, value) pairs and de-duplicated by an
    aggregate with a map-side partial step, so a hot category is combined before the
    shuffle. Only the distinct values reach the driver; each becomes a column, so they
    are as many as a row can hold.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), q(c).alias("v")) for i, c in enumerate(columns)])
    exploded = (
        df.select(F.explode(pairs).alias("p"))
        .select(F.col("p.i").alias("i"), F.explode(F.col("p.v")).alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("i", "v")
        .agg(F.lit(1).alias("_"))
    )
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in exploded.select("i", "v").collect():
        found[columns[row.i]].append(row.v)
    for vs in found.values():
        vs.sort()
    return found


def category_dictionary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A2 as a table, for lists with more categories than a row has room for: ``column``,
    ``value`` and ``flag`` (its number from 0, in the order of column and value). The
    distinct values are numbered over ranges; nothing reaches the driver."""
    pairs = [F.struct(F.lit(c).alias("column"), q(c).alias("vs")) for c in columns or list_columns(df)]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column string, value string, flag long")
    values = df.select(F.explode(F.array(*pairs)).alias("p")).select(F.col("p.column").alias("column"), F.explode("p.vs").alias("value"))
    found = values.where("value is not null").distinct()
    return numbered(found, [F.col("column"), F.col("value")], "place").select("column", "value", (F.col("place") - 1).alias("flag"))


def sparse_flags(df: DataFrame, dictionary: DataFrame | None = None, name: str = "flags") -> DataFrame:
    """F3 for any number of categories: the numbers (``category_dictionary``) of the
    categories that a row's lists hold, ascending, as one array column; lists stay.

    Values outside a given dictionary are left out. Rows are written with a number of
    their own, so that their values can be looked up apart and put together again."""
    spark, columns = df.sparkSession, list_columns(df)
    known = category_dictionary(df, columns) if dictionary is None else dictionary
    path = scratch_path(spark, "sparse-flags")
    df.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    held = F.array(*[F.struct(F.lit(c).alias("column"), F.array_distinct(q(c)).alias("vs")) for c in columns])
    values = rows.select("__row", F.explode(held).alias("h")).select("__row", F.col("h.column").alias("column"), F.explode("h.vs").alias("value")).where("value is not null")
    flags = values.join(known, ["column", "value"]).groupBy("__row").agg(F.array_sort(F.collect_set("flag")).alias("__flags"))
    joined = rows.join(flags, "__row", "left")
    return joined.select(*[q(c) for c in df.columns], F.coalesce("__flags", F.array().cast("array<bigint>")).alias(name))


def one_hot_lists(df: DataFrame, categories: dict[str, list[str]] | None = None) -> DataFrame:
    """for each list column and category, ``<col>_<clean(category)>`` is 1 when the
    list contains the category, else 0 (null list counts as 0), as a byte column.
    The list columns are kept; ``drop_list_columns`` removes them.

    ``categories`` may be given (e.g. from the form's choices) to skip the scan; a list
    column without categories raises, and so does a row with a value outside them.
    Two categories that clean to one name, or a flag that would overwrite an existing
    column, raise (D-2).
    """
    cols = list_columns(df)
    if not cols:
        return df
    cats = categories if categories is not None else distinct_values(df, cols)
    if categories is not None and (unknown := [c for c in cols if c not in cats]):
        raise ValueError(f"no categories given for the list columns {unknown}")
    existing = set(df.columns)
    flags = []
    seen: dict[str, tuple[str, str]] = {}
    for c in cols:
        checked = q(c)
        if categories is not None:
            other = F.array_except(F.filter(q(c), lambda v: v.isNotNull()), F.array(*[F.lit(x) for x in cats[c]]).cast(df.schema[c].dataType))
            message = F.concat(F.lit(f"values of {c} outside its categories: "), F.to_json(other))
            checked = F.when(F.size(other) > 0, F.raise_error(message).cast(df.schema[c].dataType)).otherwise(q(c))
        for cat in cats[c]:
            name = f"{c}_{clean_name(cat)}"
            if name in seen or name in existing:
                other = seen.get(name, (name, "existing column"))
                raise ValueError(f"flag column {name!r} from {c!r}/{cat!r} collides with {other}")
            seen[name] = (c, cat)
            flags.append(F.coalesce(F.array_contains(checked, F.lit(cat)), F.lit(False)).cast("byte").alias(name))
    return df.select(*[q(x) for x in df.columns], *flags)


def flatten_submissions(df: DataFrame, id_col: str = "instanceid", sort: bool = True, categories: dict[str, list[str]] | None = None) -> DataFrame:
    """F3 + P5 + P3 + O1: flags, drop the lists, alphabetical columns, and (optionally)
    the canonical row sort by the pre-sort column order."""
    flagged = drop_list_columns(one_hot_lists(df, categories), id_col)
    order = list(flagged.columns)
    out = canonical_columns(flagged)
    return canonical_sort(out, order) if sort else out
