"""Views over the mart by segment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from usagemart.functions.numeric import exact_avg
from usagemart.functions.temporal import completed_years
from usagemart.functions.text import full_name

LEADERS_OF_BUCKET = 100  # kept with each bucket of the mart

# The two verdicts of the band test.
IN_BAND = "В рамках сегмента"
OUT_OF_BAND = "Требует пересмотра сегмента"

_BAND_TEST = "engagement_score BETWEEN min_engagement_score AND max_engagement_score"


def _with_band(mart: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join to the dimension by code. The bands overlap, so a range join would be wrong.

    There is no broadcast hint: Spark knows the dimension's size and broadcasts it while it is
    small; a large one is joined by sort-merge, where AQE splits a segment that is too big.
    """
    bands = dim.selectExpr("segment_code AS _code", "segment_name", "min_engagement_score",
                           "max_engagement_score")
    return mart.join(bands, F.expr("segment = _code"), "left")


def customer_analytics(mart: DataFrame, dim: DataFrame, as_of: datetime) -> DataFrame:
    """The mart with full name, segment name, years as a customer and the band verdict."""
    return _with_band(mart, dim).selectExpr(
        "customer_id",
        f"{full_name('first_name', 'last_name')} AS full_name",
        "email", "company", "segment", "segment_name", "registration_date",
        f"{completed_years('registration_date', as_of.date())} AS years_as_customer",
        "status", "lifetime_value", "total_session_minutes", "avg_session_minutes",
        "active_days", "total_page_views", "total_clicks", "total_conversions",
        "conversion_rate", "engagement_score",
        f"if({_BAND_TEST}, '{IN_BAND}', '{OUT_OF_BAND}') AS segment_validation",
        "load_date", "updated_at",
    )


def segment_review(mart: DataFrame, dim: DataFrame) -> DataFrame:
    """Customers whose score lies outside their segment's band, or whose segment has none."""
    return _with_band(mart, dim).where(f"NOT coalesce({_BAND_TEST}, false)").select(
        "customer_id", "segment", "engagement_score", "min_engagement_score",
        "max_engagement_score")


def segment_performance(mart: DataFrame) -> DataFrame:
    return mart.groupBy("segment").agg(*map(F.expr, [
        "count(1) AS customer_count",
        f"{exact_avg('lifetime_value')} AS avg_lifetime_value",
        f"{exact_avg('engagement_score')} AS avg_engagement",
        "sum(total_conversions) AS total_conversions",
        f"{exact_avg('conversion_rate')} AS avg_conversion_rate",
        "max(load_date) AS last_update_date",
    ]))


def segment_load_stats(mart: DataFrame) -> DataFrame:
    """Count and mean engagement per segment; customers without a segment form a group."""
    return mart.groupBy("segment").agg(
        F.expr("count(1) AS n"), F.expr(f"{exact_avg('engagement_score')} AS avg_engagement"))


def segment_value_counts(mart: DataFrame) -> DataFrame:
    """How often each segment occurs, most frequent first; a missing segment is not counted."""
    return segment_counts(mart.where("segment IS NOT NULL"))


def segment_counts(mart: DataFrame) -> DataFrame:
    return (mart.groupBy("segment").agg(F.expr("count(1) AS n"))
            .orderBy(F.desc("n"), F.asc_nulls_last("segment")))


def top_segment(mart: DataFrame) -> DataFrame:
    """The largest segment; of equally large ones the first by name."""
    return segment_counts(mart).limit(1)


def segment_map(mart: DataFrame, as_of: datetime) -> DataFrame:
    """Load statistics as one row with a map keyed by segment, and when they were taken.

    The map is built from the per-segment result, so it has one entry per distinct segment.
    """
    return segment_load_stats(mart).selectExpr(
        "coalesce(sum(n), 0) AS total_records",
        """map_from_entries(collect_list(struct(
             coalesce(segment, 'null'), struct(n AS count, avg_engagement))))
           AS segment_distribution""",
        f"'{as_of.isoformat()}' AS loaded_at")


def leaders(mart: DataFrame, k: int = LEADERS_OF_BUCKET) -> DataFrame:
    """The ``k`` highest scores of each ``bucket``; whoever is among the first ``k`` of all is among them."""
    order = Window.partitionBy("bucket").orderBy(F.desc("engagement_score"), "customer_id")
    return (mart.select("bucket", "customer_id", "engagement_score").withColumn("_place", F.row_number().over(order))
            .where(F.col("_place") <= k).drop("_place"))


def top_engaged(mart: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest scores: each task keeps its own ``k`` rows, nothing is sorted whole."""
    return (mart.select("customer_id", "engagement_score")
            .orderBy(F.desc("engagement_score"), "customer_id").limit(k))
