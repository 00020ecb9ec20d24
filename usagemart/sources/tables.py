"""Catalog tables: the declared mart for SQL users, and bucketed sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from usagemart.schemas import DECLARED_MART_SCHEMA

MART_COMMENT = "One row per customer with aggregated telemetry"


def _column(field: T.StructField) -> str:
    limit, comment = field.metadata.get("max_length"), field.metadata.get("comment")
    dtype = f"VARCHAR({limit})" if limit else field.dataType.simpleString()
    return f"{field.name} {dtype}" + (f" COMMENT '{comment}'" if comment else "")


def create_mart_table(spark: SparkSession, name: str, path: str,
                      schema: T.StructType = DECLARED_MART_SCHEMA) -> None:
    """Create the typed, commented mart table unless it exists. Inserts check lengths."""
    columns = ", ".join(_column(f) for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"LOCATION '{path}' COMMENT '{MART_COMMENT}'")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int,
                   partition_by: str | None = None) -> None:
    """Store a source bucketed by ``key``.

    Tables with the same buckets aggregate and join on the key without a shuffle. Telemetry is
    partitioned by date as well, so that a load reads only its days.
    """
    writer = (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
              .bucketBy(buckets, key).sortBy(key))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
