"""Append-only log of the jobs."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagemart.schemas import AUDIT_SCHEMA


def audit_row(spark: SparkSession, process: str, execution_date: date, start: datetime,
              end: datetime, records: int, status: str, error: str | None = None) -> DataFrame:
    """One log entry. The id is drawn here, once, so a retried task writes the same row."""
    values = {
        "audit_id": uuid.uuid4().hex, "process_name": process,
        "execution_date": execution_date.isoformat(), "start_time": start.isoformat(),
        "end_time": end.isoformat(), "records_processed": str(records), "status": status,
        "error_message": error, "created_at": end.isoformat(),
    }
    # Everything arrives as text and is cast, so no time zone can touch the timestamps.
    return spark.range(0, 1, 1, numPartitions=1).select(*(
        F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA))


def append_audit(entry: DataFrame, path: str) -> None:
    entry.write.mode("append").partitionBy("execution_date").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path).select(*AUDIT_SCHEMA.fieldNames())
