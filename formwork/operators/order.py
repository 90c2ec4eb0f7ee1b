"""Global row numbers of an ordered frame without a window over all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formwork.session import scratch_path

_SEQ = (1 << 33) - 1


def numbered(df: DataFrame, keys: list[Column], name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in the order of ``keys``.

    Rows are dealt to ranges of the keys and sorted within them; range and place in it
    are written with the rows, so both readers below see the same ones. The counts of the
    ranges, one number per range, give the offset of each. Rows equal in all keys get
    places of their own, in no set order; a key that many rows share fills its range, so
    give keys that tell rows apart where one value is frequent."""
    spark = df.sparkSession
    sorted_ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = scratch_path(spark, "numbered")
    sorted_ranges.select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().bitwiseAND(F.lit(_SEQ)).alias("__place")).write.parquet(path)
    rows = spark.read.parquet(path)
    offsets, before = [], 0
    for r in rows.groupBy("__range").agg(F.count(F.lit(1)).alias("n")).orderBy("__range").collect():  # one row per range
        offsets.append((r["__range"], before))
        before += r["n"]
    table = spark.createDataFrame(offsets, "__range int, __before long")
    return rows.join(F.broadcast(table), "__range").select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns], (F.col("__before") + F.col("__place") + 1).alias(name))
