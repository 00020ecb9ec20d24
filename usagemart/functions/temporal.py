"""Dates, ages and the three freshness policies.

Time never comes from the clock: every expression takes ``as_of``. Timestamps carry no zone, so
nothing here depends on the session's time zone.
"""

from __future__ import annotations

from datetime import date, datetime

# Freshness buckets and the colour shown for each.
FRESHNESS_COLORS = {"fresh": "green", "recent": "blue", "daily": "yellow", "stale": "red"}
UNKNOWN_COLOR = "gray"


def ts_literal(moment: datetime) -> str:
    return f"TIMESTAMP_NTZ '{moment.isoformat(sep=' ')}'"


def date_literal(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def newer_than(moment: str, as_of: datetime, interval: str) -> str:
    """``moment`` lies strictly within the last ``interval`` before ``as_of``."""
    return f"{moment} > {ts_literal(as_of)} - INTERVAL {interval}"


def completed_years(since: str, day: date) -> str:
    """Whole years between two dates, truncated toward zero.

    29 February to 28 February is not a full year, which month arithmetic would say it is.
    """
    on = date_literal(day)

    def years(low: str, high: str) -> str:
        month_day = "(month({0}) * 100 + day({0}))".format
        return (f"year({high}) - year({low})"
                f" - if({month_day(high)} < {month_day(low)}, 1, 0)")

    return f"if({since} > {on}, -({years(on, since)}), {years(since, on)})"


def report_freshness(updated_at: str, as_of: datetime) -> str:
    """Report page policy: fresh while less than one whole day old."""
    return f"if({newer_than(updated_at, as_of, '1 DAY')}, 'fresh', 'stale')"


def status_freshness(updated_at: str, as_of: datetime) -> str:
    """Status policy: 5 minutes, 1 hour, 24 hours; never updated counts as stale."""
    return (f"CASE WHEN {newer_than(updated_at, as_of, '5 MINUTES')} THEN 'fresh'"
            f" WHEN {newer_than(updated_at, as_of, '1 HOUR')} THEN 'recent'"
            f" WHEN {newer_than(updated_at, as_of, '24 HOURS')} THEN 'daily'"
            " ELSE 'stale' END")


def within_two_days(updated_at: str, as_of: datetime) -> str:
    """Summary policy: at most one whole day old, NULL when never updated."""
    return newer_than(updated_at, as_of, "2 DAYS")


def freshness_color(bucket: str) -> str:
    pairs = ", ".join(f"'{name}', '{color}'" for name, color in FRESHNESS_COLORS.items())
    return f"coalesce(try_element_at(map({pairs}), {bucket}), '{UNKNOWN_COLOR}')"


def parse_date(text: str) -> str:
    """ISO date; junk becomes NULL and is counted by the quality report."""
    return f"try_to_date({text}, 'yyyy-MM-dd')"


def parse_timestamp(text: str) -> str:
    """ISO timestamp whose fraction is absent when it is zero."""
    return f"to_timestamp_ntz({text}, \"yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]\")"


def iso_date(day: str) -> str:
    return f"CAST({day} AS string)"


def iso_timestamp(moment: str) -> str:
    """ISO text with a six-digit fraction, which is left out when it is zero."""
    text = f"replace(CAST({moment} AS string), ' ', 'T')"
    return f"if(length({text}) > 19, rpad({text}, 26, '0'), {text})"


def page_time(moment: str) -> str:
    """``1/31/2024, 2:05:09 AM`` from the parts of the timestamp, which no time zone touches."""
    two = "lpad({}({}), 2, '0')".format
    return (f"concat(month({moment}), '/', day({moment}), '/', year({moment}), ', ', "
            f"(hour({moment}) + 11) % 12 + 1, ':', {two('minute', moment)}, ':', {two('second', moment)}, "
            f"if(hour({moment}) < 12, ' AM', ' PM'))")


def epoch_seconds(moment: str) -> str:
    """Whole seconds since 1970 of a timestamp without zone, read as UTC."""
    since = f"CAST({moment} - TIMESTAMP_NTZ '1970-01-01 00:00:00' AS INTERVAL SECOND)"
    return f"CAST(floor(CAST({since} AS decimal(18,6))) AS bigint)"
