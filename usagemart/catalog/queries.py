"""One query per operator, over the warehouse tables below ``folder``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from usagemart.operators import (
    access, mart as marts, quality, reports, segments, telemetry as tel_ops, upsert)
from usagemart.plans.home import Home, read_mart
from usagemart.plans.nightly import run_nightly
from usagemart.plans.refresh import refresh_on_demand
from usagemart.schemas import TELEMETRY_SCHEMA
from usagemart.session import materialize, scratch_path
from usagemart.sources import readers, warehouse
from usagemart.sources.audit import append_audit, audit_row, read_audit
from usagemart.sources.dimensions import segment_dim
from usagemart.sources.staging import read_staging, write_staging
from usagemart.streaming.telemetry_stream import stream_upsert

EXECUTION_DATE = date(2024, 1, 30)
AS_OF = datetime(2024, 1, 31)
DAY = timedelta(days=1)
MONTH_DAYS = 30
# The deliveries: today's brings all active accounts; yesterday's brought customers whose first order is
# older than this and all other accounts, so that both together are the whole table.
_ACTIVE = "status = 'active'"
_KNOWN = f"registration_date < '1996-01-01' OR NOT ({_ACTIVE})"
TOP_K = 10

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which both engines hand out the same value."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, T.DecimalType) for f in fields):
        return df
    return df.selectExpr(*(
        f"CAST(`{f.name}` AS double) AS `{f.name}`" if isinstance(f.dataType, T.DecimalType)
        else f"`{f.name}`" for f in fields))


# -- inputs ----------------------------------------------------------------------------------

def customers(spark: SparkSession, folder: str) -> DataFrame:
    return readers.read_customers(spark, warehouse.customers(spark, folder))


def two_days(spark: SparkSession, folder: str, last: date = EXECUTION_DATE) -> DataFrame:
    tel = warehouse.telemetry(spark, folder, last, days=2)
    return readers.read_telemetry(spark, tel, last)


def month(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.telemetry(spark, folder, EXECUTION_DATE, MONTH_DAYS)


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return marts.customer_mart(customers(spark, folder), two_days(spark, folder),
                               EXECUTION_DATE, AS_OF)


def _typed(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    seen = rows.join(warehouse.last_seen(spark, folder), "customer_id", "left")
    return marts.to_mart_types(seen, updated_at="seen_at")


def mart(spark: SparkSession, folder: str) -> DataFrame:
    return _typed(spark, folder, staged(spark, folder))


def yesterday(spark: SparkSession, folder: str) -> DataFrame:
    """The mart as loaded the day before from that day's delivery."""
    return _day_before(spark, folder, customers(spark, folder).where(_KNOWN))


def _day_before(spark: SparkSession, folder: str, known: DataFrame) -> DataFrame:
    before = EXECUTION_DATE - DAY
    rows = marts.customer_mart(known, two_days(spark, folder, before), before, AS_OF - DAY)
    return _typed(spark, folder, rows)


def today(spark: SparkSession, folder: str) -> DataFrame:
    """Today's delivery: all active accounts, some of them new."""
    return marts.to_mart_types(staged(spark, folder).where(_ACTIVE))


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    return access.access_decisions(warehouse.claims(spark, folder), mart(spark, folder))


def _stored_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The mart built once, for queries that use it twice."""
    return materialize(mart(spark, folder), "mart")


def _access_filter(spark, folder):
    built = _stored_mart(spark, folder)
    return access.restrict(built, access.access_decisions(warehouse.claims(spark, folder), built))


def report(spark: SparkSession, folder: str) -> DataFrame:
    return reports.customer_report(mart(spark, folder), AS_OF)


# -- queries that are more than one operator on one input ------------------------------------

def _new_home(spark: SparkSession) -> Home:
    """Empty tables in the shared scratch folder, one bucket per task slot of the cluster."""
    return Home(spark, scratch_path(spark, "home"), buckets=spark.sparkContext.defaultParallelism)


def _extract_counts(spark, folder):
    return marts.extract_metrics(customers(spark, folder), two_days(spark, folder), AS_OF)


def _segments_in_use(spark, folder):
    """Every segment that customers have, with its dimension row if there is one."""
    used = customers(spark, folder).select("segment").distinct()
    dim = segment_dim(spark)
    return used.join(dim, F.expr("segment = segment_code"), "left")


def _csv_round_trip(spark, folder):
    path = scratch_path(spark, "staging")
    write_staging(staged(spark, folder), path, "csv")
    return read_staging(spark, path, EXECUTION_DATE, "csv")


def _mart_scan(spark, folder):
    home = _new_home(spark)
    home.mart.replace(mart(spark, folder))
    return read_mart(spark, home.root)


def _manual_refresh(spark, folder):
    return upsert.refresh_customers(mart(spark, folder), decisions(spark, folder)
                                    .where(f"decision = '{access.ALLOWED}'"), AS_OF)[1]


def _refresh_run(spark, folder):
    home = _new_home(spark)
    home.mart.replace(_day_before(spark, folder, customers(spark, folder)))
    ids = access.allowed_customers(decisions(spark, folder))
    refresh_on_demand(home, ids, AS_OF, customers(spark, folder), two_days(spark, folder))
    return home


def _nights(spark, folder):
    """Two nights, one delivery each."""
    home = _new_home(spark)
    source = customers(spark, folder)
    before = EXECUTION_DATE - DAY
    tel = warehouse.telemetry(spark, folder, EXECUTION_DATE, days=3)
    run_nightly(home, source.where(_KNOWN), tel, before,
                AS_OF - DAY)
    return home, run_nightly(home, source.where(_ACTIVE), tel, EXECUTION_DATE,
                             AS_OF, staging_format="csv")


def _nightly_report(spark, folder):
    """The stored report of the second night."""
    home, _ = _nights(spark, folder)
    stored = spark.read.parquet(home.reports).where(F.col("execution_date") == EXECUTION_DATE)
    return stored.withColumn("execution_date", F.col("execution_date").cast("string"))


def _audit_log(spark, folder):
    path = scratch_path(spark, "audit")
    loaded = mart(spark, folder).count()
    refreshed = _manual_refresh(spark, folder).count()
    for process, records in [("nightly_load", loaded), ("manual_report_generation", refreshed)]:
        append_audit(audit_row(spark, process, EXECUTION_DATE, AS_OF - DAY, AS_OF, records,
                               "success"), path)
    return read_audit(spark, path).drop("audit_id")


def _mart_metadata(spark, folder):
    return marts.load_metadata(staged(spark, folder)).selectExpr(
        "row_count", "concat_ws(',', columns) AS columns",
        "explode(customer_segments) AS (segment, n)")


def _segment_map(spark, folder):
    result = segments.segment_map(mart(spark, folder), AS_OF)
    return result.selectExpr("total_records", "loaded_at", "explode(segment_distribution)").selectExpr(
        "total_records", "loaded_at", "key AS segment", "value.count AS n", "value.avg_engagement")


def _dq_issues(spark, folder):
    found = quality.dq_issues(quality.dq_checks(mart(spark, folder)))
    return found.selectExpr("concat_ws('; ', issues) AS issues",
                            "CAST(size(issues) AS bigint) AS issue_count",
                            "is_valid", "total_records")


def _duplicate_keys(spark, folder):
    """Two deliveries taken together: the customers that are in both."""
    both = yesterday(spark, folder).unionByName(today(spark, folder))
    return quality.duplicate_keys(both, "customer_id")


def _flat(nested: DataFrame, *keep: str) -> DataFrame:
    return nested.select(*keep, "customer.*", "telemetry.*", "financial.*", "metadata.*")


def _report_nested(spark, folder):
    return _flat(reports.nest_report(report(spark, folder)))


def _report_envelope(spark, folder):
    built = _stored_mart(spark, folder)
    envelope = reports.report_envelope(
        reports.customer_report(built, AS_OF),
        access.access_decisions(warehouse.claims(spark, folder), built))
    one = envelope.selectExpr("email AS caller", "access_level", "n", "message",
                              "explode(reports) AS r")
    return _flat(one.select("caller", "access_level", "n", "message", "r.*"),
                 "caller", "access_level", "n", "message")


def _report_json(spark, folder):
    documents = reports.report_json(report(spark, folder))
    at = "get_json_object(document, '$.{}')".format
    return documents.selectExpr(
        "customer_id",
        f"CAST({at('customer.id')} AS bigint) AS id",
        f"{at('customer.name')} AS name",
        f"{at('customer.email')} AS email",
        f"{at('customer.registration_date')} AS registration_date",
        f"CAST({at('telemetry.total_hours')} AS double) AS total_hours",
        f"CAST({at('financial.value_per_hour')} AS double) AS value_per_hour",
        f"{at('metadata.updated_at')} AS updated_at",
        f"{at('metadata.created_at')} AS created_at")


def _stream(spark, folder):
    """The mart starts without telemetry, and the stream brings the whole table in several batches.

    What lies outside the last two months comes first, then the last two weeks, and the weeks before late; the
    execution date moves with the batches. Each arrival is a batch of as many files as tasks wrote it.
    """
    home = _new_home(spark)
    source = customers(spark, folder)
    events = warehouse.table(spark, folder, "events")
    inbox, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "stream")
    nothing = spark.createDataFrame([], TELEMETRY_SCHEMA)
    idle = marts.customer_mart(source, nothing, EXECUTION_DATE, AS_OF)
    home.mart.replace(marts.to_mart_types(idle))

    def between(first: int, last: int) -> str:
        """Days counted back from the execution date."""
        low, high = EXECUTION_DATE - first * DAY, EXECUTION_DATE + (1 - last) * DAY
        return f"ts >= TIMESTAMP_NTZ '{low} 00:00:00' AND ts < TIMESTAMP_NTZ '{high} 00:00:00'"

    recent = between(2 * MONTH_DAYS - 1, 0)
    arrivals = [(25, f"NOT coalesce({recent}, false)"), (20, between(14, 0)), (12, between(59, 45)),
                (5, between(29, 15)), (0, between(44, 30))]
    for days_back, arrival in arrivals:
        events.where(arrival).write.mode("append").parquet(inbox)
        arrived = spark.readStream.schema(events.schema).parquet(inbox)
        stream_upsert(warehouse.event_metrics(arrived), source, home, checkpoint,
                      execution_date=lambda: EXECUTION_DATE - days_back * DAY, clock=lambda: AS_OF,
                      window_days=MONTH_DAYS).awaitTermination()
    return home


# -- registry --------------------------------------------------------------------------------

def _on_mart(operator: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: operator(mart(spark, folder), *args, **kwargs)


def _on_report(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(report(spark, folder))


QUERIES: dict[str, Query] = {
    "src_customers": customers,
    "src_telemetry": two_days,
    "extract_counts": _extract_counts,
    "segment_dim": _segments_in_use,
    "mart_scan": _mart_scan,
    "csv_round_trip": _csv_round_trip,
    "telemetry_agg": lambda s, d: tel_ops.telemetry_agg(two_days(s, d)),
    "telemetry_agg_30d": lambda s, d: tel_ops.telemetry_agg(month(s, d), EXECUTION_DATE, 30),
    "customer_mart": staged,
    "mart_typed": lambda s, d: marts.to_mart_types(staged(s, d)),
    "mart_metadata": _mart_metadata,
    "mart_sample": _on_mart(marts.sample_rows, 3),
    "mart_upsert": lambda s, d: upsert.upsert_mart(yesterday(s, d), today(s, d), AS_OF),
    "insert_ignore": lambda s, d: upsert.insert_ignore(yesterday(s, d), today(s, d)),
    "manual_refresh": _manual_refresh,
    "refresh_run": lambda s, d: _refresh_run(s, d).mart.read(),
    "refresh_run_performance": lambda s, d: _refresh_run(s, d).segment_performance(),
    "audit_log": _audit_log,
    "customer_analytics": lambda s, d: segments.customer_analytics(
        mart(s, d), segment_dim(s), AS_OF),
    "segment_review": lambda s, d: segments.segment_review(mart(s, d), segment_dim(s)),
    "segment_performance": _on_mart(segments.segment_performance),
    "segment_value_counts": _on_mart(segments.segment_value_counts),
    "segment_load_stats": _on_mart(segments.segment_load_stats),
    "segment_map": _segment_map,
    "segment_counts": _on_mart(segments.segment_counts),
    "top_segment": _on_mart(segments.top_segment),
    "top_engaged": _on_mart(segments.top_engaged, TOP_K),
    "caller_info": lambda s, d: access.caller_info(warehouse.claims(s, d)),
    "access_decisions": decisions,
    "access_filter": _access_filter,
    "customer_report": report,
    "reports_ordered": _on_report(reports.order_reports),
    "customer_report_nested": _report_nested,
    "report_envelope": _report_envelope,
    "report_json": _report_json,
    "report_display": _on_report(reports.report_display),
    "report_json_dates": _on_report(reports.format_dates),
    "customer_summary": _on_mart(reports.customer_summary, AS_OF),
    "freshness_status": _on_mart(reports.freshness_status, AS_OF),
    "user_segments": _on_mart(reports.user_segments),
    "user_segment_list": lambda s, d: reports.user_segment_list(mart(s, d)).selectExpr(
        "email", "concat_ws(',', segments) AS segments", "n"),
    "dq_checks": _on_mart(quality.dq_checks),
    "dq_issues": _dq_issues,
    "dq_duplicate_keys": _duplicate_keys,
    "dq_type_violations": lambda s, d: quality.type_violations(staged(s, d)),
    "run_report": _on_mart(quality.run_report, EXECUTION_DATE),
    "nightly_run": lambda s, d: _nights(s, d)[1].mart,
    "nightly_run_performance": lambda s, d: _nights(s, d)[1].segment_performance,
    "nightly_run_report": _nightly_report,
    # The date of a customer's last load depends on the batch that brought their last change.
    "stream_telemetry_agg": lambda s, d: _stream(s, d).mart.read().drop("load_date"),
    "stream_performance": lambda s, d: _stream(s, d).segment_performance(),
}


def _registered(query: Query, spark: SparkSession, folder: str) -> DataFrame:
    return plain(query(spark, folder))


def registered() -> dict[str, Query]:
    return {name: partial(_registered, query) for name, query in QUERIES.items()}
