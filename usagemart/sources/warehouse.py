"""The order and event tables of a warehouse, seen as customers, telemetry and callers."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from usagemart.functions.temporal import epoch_seconds, iso_date, ts_literal
from usagemart.operators.telemetry import daily_rollup

_TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}

_SEGMENT_OF = {
    "AUTOMOBILE": "standard",
    "BUILDING": "premium",
    "FURNITURE": "enterprise",
    "HOUSEHOLD": "inactive",
    "MACHINERY": "partner",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _email(key: str) -> str:
    return f"concat('user', {key}, '@example.com')"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer master records; some lack a first name or an email."""
    codes = ", ".join(f"'{name}', '{code}'" for name, code in _SEGMENT_OF.items())
    spent = table(spark, folder, "orders").groupBy(F.expr("o_custkey AS c_custkey")).agg(
        F.expr("min(o_orderdate) AS first_order"),
        F.expr("sum(CAST(o_totalprice AS decimal(12,2))) AS spent"))
    nations = table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    # Nations first: later joins by customer then keep one partitioning.
    return (
        table(spark, folder, "customer")
        .join(nations, "c_nationkey", "left")
        .join(spent, "c_custkey", "left")
        .selectExpr(
            "c_custkey AS customer_id",
            "if(c_custkey % 50 = 7, NULL, split_part(c_name, '#', 1)) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            f"if(c_custkey % 97 = 5, NULL, {_email('c_custkey')}) AS email",
            "n_name AS company",
            f"try_element_at(map({codes}), c_mktsegment) AS segment",
            f"{iso_date('CAST(first_order AS date)')} AS registration_date",
            "if(c_acctbal < 0, 'suspended', 'active') AS status",
            "CAST(spent AS double) AS lifetime_value",
        )
    )


def event_metrics(events: DataFrame) -> DataFrame:
    """Each event as a telemetry row; works on streams as well."""
    return events.selectExpr(
        "user_id AS customer_id",
        "CAST(ts AS date) AS date",
        "CAST(value AS decimal(10,2)) AS session_duration_minutes",
        "if(event_type = 'view', 1L, 0L) AS page_views",
        "if(event_type = 'click', 1L, 0L) AS clicks",
        "if(event_type = 'purchase', 1L, 0L) AS conversions",
    )


def telemetry(spark: SparkSession, folder: str, last: date, days: int) -> DataFrame:
    """Daily telemetry of the ``days`` days that end with ``last``. The range is on ``ts`` itself
    and reaches the Parquet scan."""
    start = ts_literal(datetime.combine(last - timedelta(days=days - 1), time.min))
    end = ts_literal(datetime.combine(last + timedelta(days=1), time.min))
    events = table(spark, folder, "events").where(f"ts >= {start} AND ts < {end}")
    return daily_rollup(event_metrics(events))


def last_seen(spark: SparkSession, folder: str) -> DataFrame:
    """When each customer was last active."""
    return (table(spark, folder, "events").groupBy(F.expr("user_id AS customer_id"))
            .agg(F.expr("max(ts) AS seen_at")))


def claims(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a request of its user, in all the ways a caller can show up.

    Views ask for no one in particular, clicks for oneself, purchases for the customer in
    ``props``. Errors carry a username only, or nothing at all; sign-ups come from unknown users.
    """
    other = "CAST(regexp_extract(props, '[0-9]+', 0) AS bigint)"
    return table(spark, folder, "events").selectExpr(
        f"""CASE WHEN event_type IN ('view', 'click', 'purchase') THEN {_email('user_id')}
                 WHEN event_type = 'signup' THEN concat('guest', user_id) END AS email""",
        f"""CASE WHEN event_type = 'error' AND {other} >= 50 THEN {_email('user_id')} END
            AS preferred_username""",
        "'reports' AS aud",
        f"{epoch_seconds('ts')} AS iat",
        f"{epoch_seconds('ts')} + 300 AS exp",
        f"CASE event_type WHEN 'click' THEN user_id WHEN 'purchase' THEN {other} END"
        " AS requested_customer_id",
    )
