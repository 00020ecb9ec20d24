"""Where a deployment keeps its tables, and the gate every change passes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagemart.operators.quality import duplicate_keys
from usagemart.operators.segments import LEADERS_OF_BUCKET, leaders, top_engaged
from usagemart.operators.summary import performance_from, summarize
from usagemart.schemas import MART_SCHEMA
from usagemart.sources.keyed_table import KeyedTable


# Names of the mart's summaries.
SUMMARY, LEADERS = "summary", "leaders"

# A job that meets another writer starts its change again from what that one has committed.
TRIES = 5

# As many values of a list reach the Parquet reader by Spark's default.
FEW = 10


def require_unique(df: DataFrame, *keys: str) -> None:
    """Raise if one of ``keys`` is not unique. One job, which reads only the key columns."""
    found = reduce(DataFrame.unionAll, [
        duplicate_keys(df, key).select(
            F.lit(key).alias("key"), F.col(key).cast("string").alias("value"))
        for key in keys])
    example = found.agg(F.min(F.struct("key", "value"))).first()[0]
    if example is not None:
        raise ValueError(f"{example['key']} is not unique: {example['value']}")


def mart_gate(mart: DataFrame, written: DataFrame | None = None) -> None:
    """Both unique keys of the mart, checked on the merged result before anybody sees it.

    After a partial change only what was ``written`` can collide: a customer within its own
    bucket, an email with any row, so the rest of the mart is merely filtered by those emails.
    """
    if written is None:
        require_unique(mart, "customer_id", "email")
        return
    require_unique(written, "customer_id")
    emails = written.select("email").where("email IS NOT NULL").distinct()
    few = [row.email for row in emails.limit(FEW + 1).collect()]
    same = (mart.where(F.col("email").isin(few)) if len(few) <= FEW
            else mart.join(emails, "email", "left_semi"))
    require_unique(same, "email")


@dataclass(frozen=True)
class Home:
    """All tables below one shared folder."""

    spark: SparkSession
    root: str
    buckets: int = 64

    @cached_property
    def mart(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/customer_data_mart", MART_SCHEMA,
                          "customer_id", self.buckets, {SUMMARY: summarize, LEADERS: leaders}, ["email"])

    def segment_performance(self) -> DataFrame:
        """The roll-up of the current mart, from the sums that were committed with its buckets."""
        return performance_from(self.mart.summaries(SUMMARY))

    def top_engaged(self, k: int = 10) -> DataFrame:
        """The ``k`` highest scores of the current mart, from the leaders that were committed with its buckets."""
        table, now = self.mart, self.mart.latest()
        few = k <= LEADERS_OF_BUCKET and table.has_summary(LEADERS, now)
        return top_engaged(table.summaries(LEADERS, now) if few else table.read(at=now), k)

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def audit(self) -> str:
        return f"{self.root}/etl_audit_log"

    @property
    def reports(self) -> str:
        return f"{self.root}/run_reports"

    def create_views(self) -> None:
        """Register the current tables for SQL users."""
        self.mart.read().createOrReplaceTempView("customer_data_mart")
        self.segment_performance().createOrReplaceTempView("segment_performance")


def read_mart(spark: SparkSession, root: str) -> DataFrame:
    """The current mart below ``root``."""
    return Home(spark, root).mart.read()
