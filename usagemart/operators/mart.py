"""Building the customer mart."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.functions.temporal import parse_date, parse_timestamp
from usagemart.functions.text import aliased
from usagemart.operators.telemetry import telemetry_agg
from usagemart.schemas import CUSTOMER_SCHEMA, MART_SCHEMA, METRIC_TYPES


def extract_metrics(customers: DataFrame, tel: DataFrame, as_of: datetime) -> DataFrame:
    """How many records each source delivered, in one row.

    Counted by an aggregate over no columns rather than an observation on the way: accumulators
    of a shuffled stage count twice when a lost executor's tasks run again.
    """
    tagged = customers.selectExpr("1 AS c", "0 AS t").unionAll(tel.selectExpr("0", "1"))
    return tagged.selectExpr(
        "count_if(c = 1) AS customers", "count_if(t = 1) AS telemetry",
        "count(1) AS records_count", f"'{as_of.isoformat()}' AS extracted_at")


def customer_mart(customers: DataFrame, tel: DataFrame, execution_date: date, as_of: datetime,
                  window_days: int | None = None) -> DataFrame:
    """Staged mart rows: every customer with their metrics, zeros where there are none.

    Telemetry is aggregated first, so the join meets one row per customer and reuses the shuffle
    of the aggregate.
    """
    return with_metrics(customers, telemetry_agg(tel, execution_date, window_days), execution_date, as_of)


def with_metrics(customers: DataFrame, metrics: DataFrame, execution_date: date,
                 as_of: datetime) -> DataFrame:
    """Staged rows from metrics that are aggregated already."""
    master = [name for name in CUSTOMER_SCHEMA.fieldNames() if name != "lifetime_value"]
    return customers.join(metrics, "customer_id", "left").selectExpr(
        *master,
        "coalesce(nanvl(lifetime_value, NULL), 0) AS lifetime_value",
        *aliased({name: f"coalesce({name}, 0)" for name in METRIC_TYPES}),
        f"'{execution_date.isoformat()}' AS load_date",
        f"'{as_of.isoformat()}' AS created_at",
    )


def to_mart_types(staged: DataFrame, schema: T.StructType = MART_SCHEMA,
                  updated_at: str = "NULL") -> DataFrame:
    """Cast staged rows to the mart's types. A number that does not fit raises."""
    parsed = {
        "registration_date": parse_date("registration_date"),
        "load_date": parse_date("load_date"),
        "created_at": parse_timestamp("created_at"),
        "updated_at": f"CAST({updated_at} AS timestamp_ntz)",
    }
    plain = [name for name in schema.fieldNames() if name not in parsed]
    return staged.selectExpr(*plain, *aliased(parsed)).to(schema)


def stored_counts(staged: DataFrame, metrics: DataFrame, as_of: datetime) -> DataFrame:
    """``extract_metrics`` from what a run has stored: its staged rows, and metrics with ``source_rows``."""
    tagged = staged.selectExpr("1L AS c", "0L AS t").unionAll(metrics.selectExpr("0L", "source_rows"))
    return tagged.selectExpr(
        "coalesce(sum(c), 0) AS customers", "coalesce(sum(t), 0) AS telemetry",
        "coalesce(sum(c + t), 0) AS records_count", f"'{as_of.isoformat()}' AS extracted_at")


def load_metadata(staged: DataFrame) -> DataFrame:
    """What a transform reports: row count, column names, and customers per known segment.

    The map comes from the per-segment counts, so it has one entry per distinct segment.
    """
    columns = ", ".join(f"'{name}'" for name in staged.columns)
    per_segment = staged.groupBy("segment").agg(F.expr("count(1) AS n"))
    return per_segment.selectExpr(
        "coalesce(sum(n), 0) AS row_count",
        f"array({columns}) AS columns",
        """map_from_entries(collect_list(struct(segment, n)) FILTER (WHERE segment IS NOT NULL))
           AS customer_segments""")


def sample_rows(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows by customer: a look at the result, not a sample of it."""
    return df.orderBy("customer_id").limit(n)
