"""The corpus pipeline: documents through quality rules, near-dedup, substring dedup,
personal data and packing. Each stage reads the table its predecessor wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formwork.llm.frames import quoted, ship, small_batches, stored
from formwork.llm.minhash_dedup import drop_near_duplicates
from formwork.llm.packing import best_fit_pack, token_pieces
from formwork.llm.personal_data import find_personal_data
from formwork.llm.quality import judge_quality
from formwork.llm.substring_dedup import remove_repeated_passages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and the name of each column."""
    names = {c: f"doc_column_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _named(df: DataFrame, names: dict[str, str], text: str | None = None) -> DataFrame:
    """The columns of the documents under their own names, with a new text where one is
    given; ``n_chars`` follows the text."""
    out = []
    for c, plain in names.items():
        column = F.col(plain)
        if text and c == "text":
            column = F.when(F.col(plain).isNotNull(), F.col(text)) if plain in df.columns else F.col(text)
        elif text and c == "n_chars":
            column = F.length(F.col(text)).cast(df.schema[plain].dataType)
        out.append(column.alias(c))
    return df.select(*out)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    small_batches(spark)
    plain, names = _plain(docs)
    return _named(judge_quality(plain, names["text"], names["lang"]).where("kept"), names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates."""
    small_batches(spark)
    plain, names = _plain(docs)
    return _named(drop_near_duplicates(plain, names["doc_id"], names["text"]), names)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat anywhere among them; the rest of a
    text keeps its spaces and lines."""
    small_batches(spark)
    plain, names = _plain(docs)
    return _named(remove_repeated_passages(plain, names["doc_id"], names["text"], layout="text"), names, "kept_text")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets."""
    small_batches(spark)
    plain, names = _plain(docs)
    return _named(find_personal_data(plain, names["text"]), names, "masked_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in sequences."""
    small_batches(spark)
    pieces = token_pieces(docs.select("doc_id", "text"))
    return best_fit_pack(stored(pieces, "pieces"), ["doc_id", "piece"])


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("personal data", personal_data),
    ("packing", packing),
]

#: The stages have no SQL form; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result but the last is written
    as Parquet and read again as the documents of the next."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
