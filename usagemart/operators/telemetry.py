"""Telemetry roll-ups."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from usagemart.functions.numeric import conversion_rate, engagement_score, r2
from usagemart.functions.temporal import date_literal

_MEASURES = ["session_duration_minutes", "page_views", "clicks", "conversions"]


def telemetry_partials(rows: DataFrame) -> DataFrame:
    """Additive sums per customer and day; a busy customer shrinks before the shuffle."""
    return rows.groupBy("customer_id", "date").agg(
        *(F.expr(f"sum({m}) AS {m}") for m in _MEASURES))


def daily_rollup(rows: DataFrame) -> DataFrame:
    """One row per customer and day, in started minutes."""
    return telemetry_partials(rows).withColumn(
        "session_duration_minutes", F.expr("CAST(ceil(session_duration_minutes) AS bigint)"))


def last_days(tel: DataFrame, as_of_date: date, days: int) -> DataFrame:
    """The ``days`` days that end with ``as_of_date``."""
    first = as_of_date - timedelta(days=days - 1)
    return tel.where(f"date BETWEEN {date_literal(first)} AND {date_literal(as_of_date)}")


def telemetry_agg(tel: DataFrame, as_of_date: date | None = None,
                  window_days: int | None = None, count_rows: bool = False) -> DataFrame:
    """Metrics per customer, over all rows or the last ``window_days`` days.

    ``count_rows`` adds ``source_rows`` and keeps rows of no customer as one group, so that the rows read
    can be told afterwards without reading them again.

    ``active_days`` counts rows with a duration. Every aggregate has a partial form, so a customer
    with a third of all rows reaches the shuffle as one row per task.
    """
    if window_days is not None:
        tel = last_days(tel, as_of_date, window_days)
    if not count_rows:
        tel = tel.where("customer_id IS NOT NULL")
    sums = tel.groupBy("customer_id").agg(*map(F.expr, [
        "coalesce(sum(session_duration_minutes), 0) AS total_session_minutes",
        f"{r2('avg(session_duration_minutes)')} AS avg_session_minutes",
        "count(session_duration_minutes) AS active_days",
        "coalesce(sum(page_views), 0) AS total_page_views",
        "coalesce(sum(clicks), 0) AS total_clicks",
        "coalesce(sum(conversions), 0) AS total_conversions",
        *(["count(1) AS source_rows"] if count_rows else []),
    ]))
    score = engagement_score("total_session_minutes", "total_page_views", "total_clicks")
    return sums.selectExpr(
        "*",
        f"{conversion_rate('total_conversions', 'total_clicks')} AS conversion_rate",
        f"{score} AS engagement_score",
    )
