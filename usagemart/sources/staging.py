"""Staging area: one partition per load date, replaced when that date is loaded again."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagemart.schemas import STAGED_SCHEMA

# RFC 4180 quoting, nothing trimmed, NULL spelled out: empty text, quotes and line breaks survive.
_CSV = {
    "header": "true",
    "nullValue": "\\N",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# A CSV file with quoted line breaks is read by one task, so files are kept small instead.
CSV_ROWS_PER_FILE = 1_000_000


def write_staging(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write staged rows below ``load_date=``; other dates stay untouched."""
    writer = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("load_date"))
    if fmt == "csv":
        writer = writer.options(**_CSV).option("maxRecordsPerFile", CSV_ROWS_PER_FILE)
    writer.format(fmt).save(path)


def read_staging(spark: SparkSession, path: str, load_date: date | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Staged rows with the declared schema; ``load_date`` prunes to one partition."""
    reader = spark.read.schema(STAGED_SCHEMA)
    if fmt == "csv":
        reader = reader.options(**_CSV).option("multiLine", "true")
    staged = reader.format(fmt).load(path)
    if load_date is not None:
        staged = staged.where(F.col("load_date") == load_date.isoformat())
    return staged.select(*STAGED_SCHEMA.fieldNames())
