"""Validation of the mart and the report of a run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.functions.numeric import to_fixed_even
from usagemart.functions.temporal import parse_date
from usagemart.functions.text import aliased
from usagemart.operators.segments import segment_load_stats
from usagemart.schemas import DECLARED_MART_SCHEMA

# The text of each issue, by the check that finds it.
ISSUE_TEXTS = {
    "null_emails": "Found %d records with null emails",
    "negative_values": "Found %d records with negative values",
}
PASS, WARNINGS, SUCCESS = "PASS", "WARNINGS", "SUCCESS"


def dq_checks(mart: DataFrame) -> DataFrame:
    """All checks in one pass over six columns, as one row.

    ``undefined_rate`` counts customers who converted without a click: their rate has no value
    and is stored as 0.
    """
    return mart.selectExpr(
        "count(1) AS total_records",
        "count_if(email IS NULL) AS null_emails",
        "count_if(total_session_minutes < 0 OR engagement_score < 0) AS negative_values",
        "max(load_date) AS max_load_date",
        "min(load_date) AS min_load_date",
        "count_if(total_conversions > 0 AND total_clicks = 0) AS undefined_rate",
    )


def dq_issues(checks: DataFrame, strict: bool = False) -> DataFrame:
    """A text per failed check. Issues only warn, unless ``strict`` makes the query fail."""
    texts = ", ".join(f"if({check} > 0, format_string('{text}', {check}), NULL)"
                      for check, text in ISSUE_TEXTS.items())
    failure = "CAST(raise_error(concat_ws('; ', issues)) AS boolean)" if strict else "false"
    found = checks.selectExpr(f"array_compact(array({texts})) AS issues", "total_records")
    return found.selectExpr(
        "issues", f"if(size(issues) = 0, true, {failure}) AS is_valid", "total_records")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once. NULLs do not collide."""
    return (df.where(f"{key} IS NOT NULL").groupBy(key).agg(F.expr("count(1) AS n"))
            .where("n > 1"))


def _violates(field: T.StructField) -> str:
    name = field.name
    if isinstance(field.dataType, T.StringType):
        limit = field.metadata.get("max_length")
        return f"length({name}) > {limit}" if limit else "false"
    is_date = isinstance(field.dataType, T.DateType)
    fits = parse_date(name) if is_date else f"try_cast({name} AS {field.dataType.simpleString()})"
    return f"{name} IS NOT NULL AND {fits} IS NULL"


def type_violations(staged: DataFrame,
                    schema: T.StructType = DECLARED_MART_SCHEMA) -> DataFrame:
    """Per declared column, how many staged values do not fit its type or length."""
    fields = [f for f in schema if f.name in staged.columns]
    counts = staged.selectExpr(*aliased({f.name: f"count_if({_violates(f)})" for f in fields}))
    return counts.unpivot([], [f.name for f in fields], "column", "violations")


def run_report(mart: DataFrame, execution_date: date) -> DataFrame:
    """The report of a run over the whole mart; see ``report_lines``."""
    return report_lines(dq_checks(mart), segment_load_stats(mart), execution_date)


def report_lines(checks: DataFrame, stats: DataFrame, execution_date: date) -> DataFrame:
    """One line per segment, each beside the totals and the verdict.

    An empty mart has a report too: one line without a segment. The lines, one for each distinct segment,
    come to the verdict's one row as a scalar subquery.
    """
    label = "coalesce(segment, 'None')"
    average = to_fixed_even("coalesce(avg_engagement, 0)", 2)
    lines = stats.selectExpr(
        f"{label} AS segment",
        f"concat({label}, ': ', n, ' records (avg engagement: ', {average}, ')') AS line")
    every = lines.agg(F.expr("collect_list(struct(segment, line)) AS lines"))
    return dq_issues(checks).withColumn("_lines", every.scalar()).selectExpr(
        f"'{execution_date.isoformat()}' AS execution_date",
        f"'{SUCCESS}' AS status",
        "total_records",
        "inline_outer(_lines) AS (segment, line)",
        "CAST(size(issues) AS bigint) AS issues_found",
        f"if(is_valid, '{PASS}', '{WARNINGS}') AS quality",
    )
