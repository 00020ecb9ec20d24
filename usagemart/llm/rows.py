"""What the operators share: reading documents, naming a row, writing a step to the shared folder."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from usagemart.session import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), so that no other column can clash."""
    return documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                            *more)


def row_key() -> Column:
    """With ``doc_id`` names a row: rows that share both are repeated rows with equal results."""
    return F.xxhash64("text").alias("text_key")


def by_row(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on ``doc_id`` (null equals null) and ``text_key``; ``right`` has one row for each."""
    renamed = right.withColumnsRenamed({"doc_id": "_doc_id", "text_key": "_text_key"})
    on = left["doc_id"].eqNullSafe(renamed["_doc_id"]) & (left["text_key"] == renamed["_text_key"])
    return left.join(renamed, on, how).drop("_doc_id", "_text_key")


def words(text: str | Column) -> Column:
    """Runs of characters other than white space, as the word contracts have them."""
    return F.array_remove(F.split(text, SPACE), "")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once to the folder that all executors share, and read back.

    Cuts the lineage: a later loss of executors recomputes nothing before this step.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Spark drops the shuffle files of finished steps when the driver collects garbage: now, and not some time later."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(batches: Iterable, rows: int = 500) -> Iterator:
    """Slices of few rows of Arrow batches: what is made of them takes many times their own memory.

    At the end, memory that was freed goes back to the system: Python workers are reused, and stay while
    later stages run.
    """
    try:
        for batch in batches:
            for at in range(0, len(batch), rows):
                yield batch.slice(at, rows)
    finally:
        give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)


def learns(doc_id: str | Column, parts: int) -> Column:
    """Whether a row may be learnt from: crc32 of the id's text, modulo ``parts``, is not 2.

    A null id counts as the empty text.
    """
    text = F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id, F.lit(""))
    return F.crc32(text.cast("binary")) % parts != 2
