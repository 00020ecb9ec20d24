"""Customer and telemetry sources: any Spark format, always with the declared schema."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, types as T

from usagemart.functions.temporal import date_literal
from usagemart.schemas import CUSTOMER_SCHEMA, TELEMETRY_SCHEMA

Source = DataFrame | str | Mapping[str, str]


def load(spark: SparkSession, src: Source, schema: T.StructType) -> DataFrame:
    """Read ``src``: a DataFrame, a Parquet path, or options with ``format`` and ``path``.

    Files are read with ``schema``; what carries its own types is cast to it.
    """
    if isinstance(src, str):
        return spark.read.schema(schema).parquet(src)
    if isinstance(src, Mapping):
        options = dict(src)
        fmt = options.pop("format")
        path = options.pop("path", None)
        reader = spark.read.format(fmt).options(**options)
        if fmt != "jdbc":
            return reader.schema(schema).load(path)
        src = reader.load()
    return src.to(schema)


def jdbc_source(url: str, table: str, partition_column: str, lower: int, upper: int,
                partitions: int, **options: str) -> dict[str, str]:
    """Options of a JDBC read that is split over executors by a key range.

    The bounds only place the cuts; rows outside them are read by the first and last task.
    """
    return {
        "format": "jdbc", "url": url, "dbtable": table, "partitionColumn": partition_column,
        "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
        **options,
    }


def read_customers(spark: SparkSession, src: Source) -> DataFrame:
    return load(spark, src, CUSTOMER_SCHEMA)


def read_telemetry(spark: SparkSession, src: Source, execution_date: date,
                   days_back: int = 1) -> DataFrame:
    """Telemetry of the execution date and ``days_back`` days before it.

    The range is on the raw column, so it prunes ``date`` partitions or Parquet row groups.
    """
    first = execution_date - timedelta(days=days_back)
    return load(spark, src, TELEMETRY_SCHEMA).where(
        f"date BETWEEN {date_literal(first)} AND {date_literal(execution_date)}")
