"""Usage reports per customer, for all customers at once."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from usagemart.functions.numeric import (
    exact_avg, fixed, hours, per, round_even, round_even_or_zero)
from usagemart.functions.temporal import (
    date_literal, freshness_color, iso_date, iso_timestamp, newer_than, page_time, report_freshness,
    status_freshness, within_two_days)
from usagemart.functions.text import aliased, first_given, full_name
from usagemart.operators.access import allowed_customers

_CUSTOMER = ["name", "email", "segment", "registration_date", "status"]
_TELEMETRY = ["total_hours", "avg_daily_hours", "active_days", "total_page_views",
              "total_clicks", "total_conversions", "conversion_rate", "engagement_score",
              "actions_per_hour"]
_FINANCIAL = ["lifetime_value", "value_per_hour"]
_METADATA = ["load_date", "updated_at", "created_at", "data_freshness"]

_ROUNDED = {"total_hours", "avg_daily_hours", "conversion_rate", "engagement_score", "actions_per_hour", *_FINANCIAL}

REPORT_COLUMNS = ["customer_id", *_CUSTOMER, *_TELEMETRY, *_FINANCIAL, *_METADATA]

# Texts of the report envelope, the status and the summary.
SELF_ONLY = "self_only"
ACCESS_MESSAGE = "Access restricted to your own data only"
WARNING_FORMAT = "Data is %s. Consider generating a new report."
UP_TO_DATE_MESSAGE = "Data is up to date"
OUTDATED_MESSAGE = "Consider generating new report"


def customer_report(mart: DataFrame, as_of: datetime) -> DataFrame:
    """The flat report: mart values plus hours, rates per hour and freshness."""
    value = "coalesce(lifetime_value, 0)"
    derived = {
        "name": full_name("first_name", "last_name"),
        "total_hours": "_hours",
        "avg_daily_hours": per("_hours", "active_days"),
        "actions_per_hour": per("total_clicks", "_hours"),
        "value_per_hour": per(value, "_hours"),
        "conversion_rate": "coalesce(conversion_rate, 0)",
        "engagement_score": "coalesce(engagement_score, 0)",
        "lifetime_value": value,
        "data_freshness": report_freshness("updated_at", as_of),
    }
    # Rounding names its argument many times, so it comes after, on columns.
    exact = mart.selectExpr("*", f"{hours('total_session_minutes')} AS _hours").selectExpr(
        *aliased({name: derived.get(name, name) for name in REPORT_COLUMNS}))
    return exact.selectExpr(*aliased({
        name: round_even(name) if name in _ROUNDED else name for name in REPORT_COLUMNS}))


def order_reports(report: DataFrame) -> DataFrame:
    """Newest first, never-updated ones on top.

    Most customers may share the missing timestamp; ordering on by customer lets the range
    partitioner split them.
    """
    return report.orderBy(F.desc_nulls_first("updated_at"), "customer_id")


def _struct(fields: list[str], name: str) -> str:
    return f"struct({', '.join(fields)}) AS {name}"


def nest_report(report: DataFrame) -> DataFrame:
    """The report as four sub-documents."""
    return report.selectExpr(
        _struct(["customer_id AS id", *_CUSTOMER], "customer"),
        _struct(_TELEMETRY, "telemetry"),
        _struct(_FINANCIAL, "financial"),
        _struct(_METADATA, "metadata"),
    )


def report_envelope(report: DataFrame, decisions: DataFrame) -> DataFrame:
    """What an admitted caller receives.

    A caller is admitted to the one customer with their email, and a customer has one report, so
    the list needs no grouping.
    """
    documents = nest_report(report).selectExpr(
        "customer.id AS customer_id", "customer.email AS email",
        "array(struct(customer, telemetry, financial, metadata)) AS reports")
    return documents.join(allowed_customers(decisions), "customer_id", "left_semi").selectExpr(
        "email", "customer_id", f"'{SELF_ONLY}' AS access_level", "reports",
        "CAST(size(reports) AS bigint) AS n", f"'{ACCESS_MESSAGE}' AS message")


def _iso_columns() -> dict[str, str]:
    return {"registration_date": iso_date("registration_date"),
            "load_date": iso_date("load_date"),
            "updated_at": iso_timestamp("updated_at"),
            "created_at": iso_timestamp("created_at")}


def report_json(report: DataFrame) -> DataFrame:
    """Each report as JSON text with ISO dates, one document per row."""
    iso = _iso_columns()
    dated = report.selectExpr(*aliased({c: iso.get(c, c) for c in REPORT_COLUMNS}))
    return nest_report(dated).selectExpr(
        "customer.id AS customer_id",
        """to_json(struct(customer, telemetry, financial, metadata),
                   map('ignoreNullFields', 'false')) AS document""")


def format_dates(report: DataFrame) -> DataFrame:
    return report.selectExpr("customer_id", *aliased(_iso_columns()))


def report_display(report: DataFrame) -> DataFrame:
    """The columns of the report page, as text."""
    return report.selectExpr(
        f"coalesce({first_given('name')}, 'Unknown User') AS name",
        "email",
        "segment",
        f"{fixed('total_hours', 1)} AS hours_used",
        f"{fixed('engagement_score', 1)} AS engagement",
        f"concat('$', {fixed('lifetime_value', 2)}) AS lifetime_value",
        f"coalesce({page_time('updated_at')}, 'Never') AS last_updated",
        "coalesce(data_freshness, 'unknown') AS freshness",
    )


def customer_summary(mart: DataFrame, as_of: datetime) -> DataFrame:
    """Totals per customer and whether a new report is due."""
    totals = mart.groupBy("customer_id").agg(*map(F.expr, [
        "count(1) AS total_records",
        f"{exact_avg('engagement_score')} AS engagement",
        "sum(total_conversions) AS conversions",
        f"{exact_avg('lifetime_value')} AS value",
        f"{hours('sum(total_session_minutes)')} AS hours",
        "max(updated_at) AS last_update",
        "min(load_date) AS first_load",
    ]))
    current = within_two_days("last_update", as_of)
    days = f"date_diff({date_literal(as_of.date())}, first_load)"
    return totals.selectExpr(
        "customer_id",
        "total_records",
        f"{round_even_or_zero('engagement')} AS avg_engagement",
        "coalesce(conversions, 0) AS total_conversions",
        f"{round_even_or_zero('value')} AS avg_lifetime_value",
        f"{round_even('hours', 1)} AS total_usage_hours",
        "last_update",
        "first_load",
        f"coalesce({days}, 0) AS reporting_period_days",
        f"coalesce(NOT {current}, false) AS generate_new",
        f"if({current}, '{UP_TO_DATE_MESSAGE}', '{OUTDATED_MESSAGE}') AS message",
    )


def freshness_status(mart: DataFrame, as_of: datetime) -> DataFrame:
    """How fresh each customer's data is, with the hints the page shows."""
    groups = mart.groupBy("customer_id", "updated_at", "load_date").agg(
        F.expr("count(1) AS record_count"))
    recent = newer_than("updated_at", as_of, "1 HOUR")
    return groups.selectExpr(
        "*",
        f"{status_freshness('updated_at', as_of)} AS freshness",
        f"if({recent}, 'up_to_date', 'needs_update') AS recommendation",
    ).selectExpr(
        "*",
        f"{freshness_color('freshness')} AS freshness_color",
        "recommendation = 'needs_update' AS is_action_required",
        "recommendation = 'needs_update' AS show_warning",
        f"format_string('{WARNING_FORMAT}', freshness) AS warning_message",
    )


def user_segments(mart: DataFrame) -> DataFrame:
    """The distinct segments of each caller."""
    return (mart.where("email IS NOT NULL AND segment IS NOT NULL")
            .select("email", "segment").distinct())


def user_segment_list(mart: DataFrame) -> DataFrame:
    """The same as one sorted list per caller, at most one entry per segment that exists."""
    lists = mart.where("email IS NOT NULL AND segment IS NOT NULL").groupBy("email").agg(
        F.expr("sort_array(collect_set(segment)) AS segments"))
    return lists.selectExpr("email", "segments", "CAST(size(segments) AS bigint) AS n")
