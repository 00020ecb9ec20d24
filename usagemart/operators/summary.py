"""Sums of the mart by segment, from which the roll-up, the checks and the run report are made.

They are additive, so they can be kept for each bucket of the mart and added up when read: a change of
a few customers computes only those of its own buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_AVERAGED = ["lifetime_value", "engagement_score", "conversion_rate"]


def summarize(mart: DataFrame) -> DataFrame:
    """One row for each bucket and segment, in one pass; customers without a segment form a group."""
    return mart.groupBy("bucket", "segment").agg(*map(F.expr, [
        "count(1) AS n",
        *(f"CAST(sum({c}) AS decimal(28,2)) AS sum_{c}" for c in _AVERAGED),
        *(f"count({c}) AS count_{c}" for c in _AVERAGED),
        "sum(total_conversions) AS total_conversions",
        "count_if(email IS NULL) AS null_emails",
        "count_if(total_session_minutes < 0 OR engagement_score < 0) AS negative_values",
        "max(load_date) AS max_load_date",
        "min(load_date) AS min_load_date",
        "count_if(total_conversions > 0 AND total_clicks = 0) AS undefined_rate",
    ]))


def _avg(c: str) -> str:
    return f"try_divide(CAST(sum(sum_{c}) AS double), sum(count_{c}))"


def performance_from(summaries: DataFrame) -> DataFrame:
    """The roll-up by segment."""
    return summaries.groupBy("segment").agg(*map(F.expr, [
        "sum(n) AS customer_count",
        f"{_avg('lifetime_value')} AS avg_lifetime_value",
        f"{_avg('engagement_score')} AS avg_engagement",
        "sum(total_conversions) AS total_conversions",
        f"{_avg('conversion_rate')} AS avg_conversion_rate",
        "max(max_load_date) AS last_update_date",
    ]))


def load_stats_from(summaries: DataFrame) -> DataFrame:
    return summaries.groupBy("segment").agg(
        F.expr("sum(n) AS n"), F.expr(f"{_avg('engagement_score')} AS avg_engagement"))


def checks_from(summaries: DataFrame) -> DataFrame:
    """The checks of the whole mart, as one row."""
    return summaries.selectExpr(
        "coalesce(sum(n), 0) AS total_records",
        "coalesce(sum(null_emails), 0) AS null_emails",
        "coalesce(sum(negative_values), 0) AS negative_values",
        "max(max_load_date) AS max_load_date",
        "min(min_load_date) AS min_load_date",
        "coalesce(sum(undefined_rate), 0) AS undefined_rate",
    )
