"""The nightly job: sources -> staging -> mart -> roll-up -> validation -> report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from time import monotonic

from pyspark.sql import DataFrame

from usagemart.operators.mart import load_metadata, stored_counts, to_mart_types, with_metrics
from usagemart.operators.quality import dq_issues, report_lines, type_violations
from usagemart.operators.summary import checks_from, load_stats_from, performance_from
from usagemart.operators.telemetry import telemetry_agg
from usagemart.operators.upsert import KEY, upsert_mart
from usagemart.plans.home import SUMMARY, TRIES, Home, mart_gate
from usagemart.session import materialize, scratch_scope
from usagemart.sources.audit import append_audit, audit_row
from usagemart.sources.readers import Source, read_customers, read_telemetry
from usagemart.sources.staging import read_staging, write_staging

PROCESS = "nightly_load"


@dataclass(frozen=True)
class NightlyResult:
    mart: DataFrame
    segment_performance: DataFrame
    extracted: DataFrame
    staged: DataFrame
    metadata: DataFrame
    violations: DataFrame
    issues: DataFrame
    report: DataFrame


def run_nightly(home: Home, customers: Source, telemetry: Source, execution_date: date,
                as_of: datetime, days_back: int = 1, strict: bool = False,
                staging_format: str = "parquet") -> NightlyResult:
    """Load one execution date, which starts at ``as_of``. Every step reads what the step before
    wrote, so a lost executor costs its own tasks and a failed run can simply be started again."""
    with scratch_scope(home.spark) as keep:
        return _run(home, customers, telemetry, execution_date, as_of, days_back, strict, staging_format, keep)


def _run(home: Home, customers: Source, telemetry: Source, execution_date: date, as_of: datetime, days_back: int,
         strict: bool, staging_format: str, keep: Callable[[DataFrame, str], DataFrame]) -> NightlyResult:
    spark, started = home.spark, monotonic()

    def log(records: int, status: str, error: str | None = None) -> None:
        end = as_of + timedelta(seconds=monotonic() - started)
        append_audit(audit_row(spark, PROCESS, execution_date, as_of, end, records, status,
                               error), home.audit)

    try:
        source = read_customers(spark, customers)
        tel = read_telemetry(spark, telemetry, execution_date, days_back)
        metrics = materialize(telemetry_agg(tel, count_rows=True), "nightly-metrics")
        write_staging(with_metrics(source, metrics, execution_date, as_of), home.staging,
                      staging_format)
        staged = read_staging(spark, home.staging, execution_date, staging_format)

        table = home.mart
        commit, _ = table.change(
            lambda current: upsert_mart(current, table.spread(to_mart_types(staged)), as_of),
            staged.select(KEY), check=mart_gate, tries=TRIES)
        mart = table.read(at=commit)
        # A few rows for each bucket, committed with the mart, answer all that follows.
        summaries = table.summaries(SUMMARY, commit)
        issues = dq_issues(checks_from(summaries), strict)
        total = issues.select("total_records", "is_valid").first()["total_records"]
        report = report_lines(checks_from(summaries), load_stats_from(summaries), execution_date)
        (report.coalesce(1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("execution_date").parquet(home.reports))
    except Exception as failure:
        log(0, "failed", str(failure))
        raise
    log(total, "success")
    return NightlyResult(
        mart=mart,
        segment_performance=performance_from(summaries),
        extracted=keep(stored_counts(staged, metrics, as_of), "extracted"),
        staged=staged,
        metadata=load_metadata(staged),
        violations=type_violations(staged),
        issues=issues,
        report=report,
    )
