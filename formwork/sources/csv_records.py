"""CSV files cut into records in many tasks, line breaks inside quotes included.

A file with quoted line breaks cannot be cut at lines unless it is known which lines
start inside quotes. That depends on all text before, yet each line only maps the state
before it (outside or inside quotes) to the state behind it: it keeps the state, flips it,
or ends in one state whatever came before. Such maps compose, so they are summed up
within each block of a file, the few block totals are carried forward per file, and every
line then knows its state without any task reading more than its block.

Blocks in which no quote stays open at a line's end are used as they are. Lines of the
others, and of the first block of a file, which holds the header, are grouped by block and
joined to records; the head of a block that continues a record of an earlier one is
added to it. ``from_csv`` parses the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formwork.session import scratch_path

BLOCK = ("file", "start", "length")
#: States of the scan of a line: outside quotes, just behind a closing quote or at the
#: start of a field, inside quotes.
OUTSIDE, EDGE, INSIDE = 0, 1, 2


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "start"), ("file_block_length", "length"))]
    return spark.read.option("lineSep", "\n").text(path).select(*meta, F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"))


def _behind(line: Column, before: int) -> Column:
    """Whether the end of a line is inside quotes, given the state before it. A quote
    opens a field only at its start; elsewhere outside quotes it is plain text."""
    parts = F.split(line, '"', -1)

    def step(state: Column, text: Column) -> Column:
        opens = text.endswith(",") | ((text == "") & (state == EDGE))
        return F.when(state == INSIDE, F.lit(EDGE)).when(opens, F.lit(INSIDE)).otherwise(F.lit(OUTSIDE))

    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), F.lit(before), step) == INSIDE


def _mapped(lines: DataFrame) -> DataFrame:
    """Adds ``flips`` (the line flips the state) and ``ends`` (the state behind it,
    where that does not depend on the state before: 0 or 1, else null)."""
    quoted = F.contains(F.col("line"), F.lit('"'))
    out = F.when(quoted, _behind(F.col("line"), EDGE)).otherwise(F.lit(False))
    into = F.when(quoted, _behind(F.col("line"), INSIDE)).otherwise(F.lit(True))
    staged = lines.withColumn("out", out).withColumn("into", into)
    return staged.select(*lines.columns, (F.col("out") & ~F.col("into")).cast("int").alias("flips"), F.when(F.col("out") == F.col("into"), F.col("out").cast("int")).alias("ends"))


def _running(df: DataFrame, by: Window) -> DataFrame:
    """Adds ``turned`` (flips so far) and ``fixed`` (what to add to it for the state
    behind the row, null as long as no row has fixed it)."""
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("turned", F.sum("flips").over(upto))
    return df.withColumn("fixed", F.last((F.col("ends") + F.col("turned")) % 2, ignorenulls=True).over(upto))


def block_states(lines: DataFrame) -> DataFrame:
    """One row per block of the files: ``carry`` (1: its first line starts inside
    quotes) and ``plain`` (each of its lines is a record)."""
    quoted = _mapped(lines.where(F.contains(F.col("line"), F.lit('"')))).drop("line")
    quoted = _running(quoted, Window.partitionBy(*BLOCK).orderBy("seq"))
    totals = quoted.groupBy(*BLOCK).agg(
        F.max_by(F.struct("turned", "fixed"), "seq").alias("end"),
        F.max((F.col("turned") + F.coalesce("fixed", F.lit(0))) % 2).alias("opens"),
    )
    blocks = lines.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("lines"))
    blocks = blocks.join(totals, list(BLOCK), "left").select(
        *BLOCK, F.coalesce("end.turned", F.lit(0)).alias("flips"), ((F.col("end.fixed") + F.col("end.turned")) % 2).alias("ends"), F.coalesce("opens", F.lit(0)).alias("opens")
    )
    of_file = Window.partitionBy("file").orderBy("start")
    blocks = _running(blocks, of_file).withColumn("behind", (F.col("turned") + F.coalesce("fixed", F.lit(0))) % 2)
    carry = F.coalesce(F.lag("behind").over(of_file), F.lit(0))
    return blocks.withColumn("carry", carry).select(*BLOCK, "carry", ((F.col("carry") == 0) & (F.col("opens") == 0) & (F.col("start") > 0)).alias("plain"))


def _joined_lines(lines: DataFrame) -> DataFrame:
    """Records (file, start, record, text) of whole blocks with quoted line breaks;
    ``record`` counts within the block, blank lines between records are left out."""
    by = Window.partitionBy("file", "start").orderBy("seq")
    rows = _running(_mapped(lines), by)
    rows = rows.withColumn("behind", (F.col("turned") + F.coalesce("fixed", "carry")) % 2)
    rows = rows.withColumn("before", F.coalesce(F.lag("behind").over(by), "carry"))
    rows = rows.where((F.col("before") == 1) | ~F.col("line").isin("", "\r"))
    rows = rows.withColumn("record", F.sum((F.col("before") == 0).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    pieces = F.array_sort(F.collect_list(F.struct("seq", "line")))
    return rows.groupBy("file", "start", "record").agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("text"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files (column ``record``), headers and blank lines left out.

    Files are read in as many tasks as they have blocks; a record that is split over
    blocks is put together. Lines end in ``\\n`` or ``\\r\\n``;
    breaks inside quotes stay as they are. Blocks are cut anew by
    every scan; a scan that cuts them differently (the cluster grew meanwhile) fails and
    can be run again.
    """
    lines = _lines(spark, path)
    store = scratch_path(spark, "csv-blocks")
    block_states(lines).write.parquet(store)
    blocks = spark.read.parquet(store)
    found = {r["plain"] for r in blocks.select("plain").distinct().collect()}
    known = lines.join(blocks, list(BLOCK), "left")
    known = known.withColumn("plain", F.coalesce("plain", F.raise_error(F.lit("the blocks of a CSV file were cut anew; run again")).cast("boolean")))
    parts = []
    if True in found:
        parts.append(known.where("plain").select(F.col("line").alias("record")))
    if False in found:
        parts.append(_whole_records(known.where("not plain")))
    if not parts:
        return spark.createDataFrame([], "record string")
    records = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    text = F.regexp_replace("record", "\r\\z", "")
    return records.select(text.alias("record")).where("record != ''")


def _whole_records(lines: DataFrame) -> DataFrame:
    cut = _joined_lines(lines)
    heads = cut.where("record = 0").select("file", F.col("start").alias("at"), F.col("text").alias("head"))
    last = cut.groupBy("file", "start").agg(F.max("record").alias("record"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    owners = last.withColumn("owner", F.last(F.when(F.col("record") > 0, F.struct("start", "record")), ignorenulls=True).over(before))
    owners = owners.select("file", F.col("start").alias("at"), F.col("owner.start").alias("start"), F.col("owner.record").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("at", "head")))
    tails = heads.join(owners, ["file", "at"]).groupBy("file", "start", "record").agg(F.array_join(F.transform(pieces, lambda p: p["head"]), "\n").alias("tail"))
    whole = cut.where("record > 0").join(tails, ["file", "start", "record"], "left")
    whole = whole.where("start > 0 or record > 1")  # the first record of a file is its header
    return whole.select(F.concat_ws("\n", "text", "tail").alias("record"))
