"""The segment dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from usagemart.schemas import SEGMENT_SCHEMA

# Code, name, description, lowest and highest engagement score.
SEGMENTS = [
    ("standard", "Стандартный", "Базовые клиенты с умеренной активностью", 0, 50),
    ("premium", "Премиум", "Активные клиенты с высоким вовлечением", 50, 80),
    ("enterprise", "Корпоративный", "Ключевые клиенты с максимальной активностью", 80, 100),
    ("inactive", "Неактивный", "Клиенты без активности в последний период", 0, 10),
]


def segment_dim(spark: SparkSession) -> DataFrame:
    """The dimension as an inline table, whose exact size Spark knows when it plans a join.

    Rows handed over from Python would have no known size and never be broadcast.
    """
    values = ", ".join(str(row) for row in SEGMENTS)
    names = ", ".join(SEGMENT_SCHEMA.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {values} AS dim({names})").to(SEGMENT_SCHEMA)
