from pyspark.sql import functions as F

from formwork.streaming.incremental import run_incremental_extract

SCHEMA = "instanceID string, `Étiquettes` array<string>, updated_at timestamp_ntz"


def batch(spark, rows, path):
    df = spark.createDataFrame(rows, "instanceID string, `Étiquettes` array<string>, updated_at string")
    df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")).write.mode("append").parquet(path)


def test_incremental_extract_processes_each_file_once(spark, tmp_dir):
    src, sink, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/sink", f"{tmp_dir}/ckpt"
    cats = {"etiquettes": ["a", "b"]}
    batch(spark, [("i1", ["a"], "2024-01-01 00:00:00"), ("i2", None, "2024-01-02 00:00:00")], src)
    run_incremental_extract(spark, src, sink, ckpt, SCHEMA, cats)
    first = spark.read.parquet(sink)
    assert first.columns == ["etiquettes_a", "etiquettes_b", "instanceid", "updated_at"]
    assert first.count() == 2
    batch(spark, [("i3", ["b", "a"], "2024-01-03 00:00:00")], src)
    run_incremental_extract(spark, src, sink, ckpt, SCHEMA, cats)
    rows = {r.instanceid: (r.etiquettes_a, r.etiquettes_b) for r in spark.read.parquet(sink).collect()}
    assert rows == {"i1": (1, 0), "i2": (0, 0), "i3": (1, 1)}
