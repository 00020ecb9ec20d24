"""Expressions whose defaults in Spark differ from what the data model asks for."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tests.fixtures import AS_OF
from usagemart.functions import numeric, temporal, text


@pytest.fixture
def value(spark):
    return lambda expression: spark.sql(f"SELECT {expression} AS v").first()[0]


@pytest.mark.parametrize("x, expected", [
    ("0.125", 0.12), ("0.135", 0.14), ("0.575", 0.58), ("0.565", 0.56), ("-0.125", -0.12),
    ("69D / 60 / 2", 0.58), ("2.345D", 2.34), ("CAST(NULL AS double)", None)])
def test_r2_rounds_ties_to_even(value, x, expected):
    assert value(numeric.r2(x)) == expected


def test_r2_has_room_for_large_values(value):
    assert value(numeric.r2("1e15D")) == 1e15


@pytest.mark.parametrize("conversions, clicks, expected", [
    ("3", "155", 1.94), ("0", "0", 0.0), ("5", "0", 0.0), ("8", "300", 2.67)])
def test_conversion_rate(value, conversions, clicks, expected):
    assert value(numeric.conversion_rate(conversions, clicks)) == expected


def test_engagement_is_not_clamped(value):
    assert value(numeric.engagement_score("1250", "3500", "2450")) == 2300.0


@pytest.mark.parametrize("amount, divisor, expected", [
    ("10", "4", 2.5), ("10", "0", 0.0), ("10", "-1", 0.0), ("10", "CAST(NULL AS int)", 0.0)])
def test_per(value, amount, divisor, expected):
    assert value(numeric.per(amount, divisor)) == expected


@pytest.mark.parametrize("x, places, expected", [
    ("0.25D", 1, "0.3"), ("0.15D", 1, "0.1"), ("0D", 1, "0.0"), ("15000.5D", 2, "15000.50"),
    ("2.65D", 1, "2.6"), ("-0.25D", 1, "-0.3")])
def test_fixed_decimals(value, x, places, expected):
    assert value(numeric.fixed(x, places)) == expected


@pytest.mark.parametrize("since, day, expected", [
    ("2024-02-29", date(2025, 2, 28), 0), ("2024-02-29", date(2025, 3, 1), 1),
    ("2023-01-31", date(2024, 1, 31), 1), ("2023-02-01", date(2024, 1, 31), 0),
    ("2025-01-31", date(2024, 1, 31), -1), ("2024-06-01", date(2024, 1, 31), 0)])
def test_completed_years(value, since, day, expected):
    assert value(temporal.completed_years(f"DATE '{since}'", day)) == expected


def test_completed_years_of_unknown_date(value):
    assert value(temporal.completed_years("CAST(NULL AS date)", AS_OF.date())) is None


@pytest.mark.parametrize("moment, expected", [
    ("2024-01-30 23:55:00.000001", "fresh"), ("2024-01-30 23:55:00", "recent"),
    ("2024-01-30 23:00:00.000001", "recent"), ("2024-01-30 23:00:00", "daily"),
    ("2024-01-30 00:00:00.000001", "daily"), ("2024-01-30 00:00:00", "stale"),
    ("2024-02-05 00:00:00", "fresh")])
def test_status_buckets_exclude_their_edge(value, moment, expected):
    assert value(temporal.status_freshness(f"TIMESTAMP_NTZ '{moment}'", AS_OF)) == expected


def test_never_updated(value):
    never = "CAST(NULL AS timestamp_ntz)"
    assert value(temporal.status_freshness(never, AS_OF)) == "stale"
    assert value(temporal.report_freshness(never, AS_OF)) == "stale"
    assert value(temporal.within_two_days(never, AS_OF)) is None


@pytest.mark.parametrize("bucket, color", [
    ("fresh", "green"), ("recent", "blue"), ("daily", "yellow"), ("stale", "red"),
    ("other", "gray")])
def test_colors(value, bucket, color):
    assert value(temporal.freshness_color(f"'{bucket}'")) == color


@pytest.mark.parametrize("written, expected", [
    ("2024-01-31T02:00:00", datetime(2024, 1, 31, 2)),
    ("2024-01-31T02:00:00.000012", datetime(2024, 1, 31, 2, 0, 0, 12))])
def test_iso_timestamps_both_ways(value, written, expected):
    parsed = temporal.parse_timestamp(f"'{written}'")
    assert value(parsed) == expected
    assert value(temporal.iso_timestamp(parsed)) == written == expected.isoformat()


def test_iso_keeps_six_digits(value):
    moment = datetime(2024, 1, 31, 2, 0, 0, 120000)
    assert value(temporal.iso_timestamp(temporal.ts_literal(moment))) == moment.isoformat()


def test_junk_date_is_null(value):
    assert value(temporal.parse_date("'31.01.2024'")) is None
    assert value(temporal.parse_date("'2024-01-31'")) == date(2024, 1, 31)


@pytest.mark.parametrize("first, last, expected", [
    ("'a'", "'b'", "a b"), ("NULL", "'b'", " b"), ("'a'", "NULL", "a "), ("NULL", "NULL", " ")])
def test_full_name(value, first, last, expected):
    assert value(text.full_name(first, last)) == expected


def test_time_expressions_ignore_the_session_zone(spark, value):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on this day in New York.
        gap = datetime(2024, 3, 10, 2, 30)
        assert value(temporal.iso_timestamp(temporal.ts_literal(gap))) == gap.isoformat()
        assert value(temporal.parse_timestamp(f"'{gap.isoformat()}'")) == gap
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_rounding_equals_that_of_binary_doubles(spark):
    """100,000 ratios, and their negatives, against Python's own rounding and exact decimals."""
    rows = spark.range(100_000).selectExpr(
        "id", "(if(id % 2 = 0, 1, -1) * CAST(id * 7 % 5003 AS double)) / (1 + id % 613) AS x").selectExpr(
        "x", f"{numeric.round_even('x')} AS two", f"{numeric.round_even('x', 1)} AS one",
        f"{numeric.fixed('x', 1)} AS text").collect()
    for r in rows:
        assert r.two == round(r.x, 2) and r.one == round(r.x, 1)
        assert Decimal(r.text) == Decimal(r.x).quantize(Decimal("0.1"), ROUND_HALF_UP)


@pytest.mark.parametrize("x", [0.0, 1e-9, 0.0039, 0.005, 0.015, 1 / 3, 0.5, 1.0, 2.675, 2.0 ** 52 + 0.5,
                               2.0 ** 53, 1e15 + 0.3, 1e18, 1 - 2.0 ** -53, 4 - 2.0 ** -51])
def test_rounding_of_odd_sizes(value, x):
    assert value(numeric.round_even(f"CAST('{x!r}' AS double)")) == round(x, 2)
    assert value(numeric.round_even(f"CAST('{-x!r}' AS double)")) == round(-x, 2)


def test_rounding_next_to_ties(spark):
    """Doubles on, just below and just above every half, of all sizes: the multiplication alone would err."""
    rows = []
    for i in range(4_000):
        half = (i * 7919 % 1_000_003 + 0.5) / 100 * 10.0 ** (i % 9 - 3)
        for x in (half, math.nextafter(half, 0), math.nextafter(half, 1e18), i + 0.125, (2 * i + 1) / 8, i * 1.005):
            rows += [(x,), (-x,)]
    for r in spark.createDataFrame(rows, "x double").selectExpr(
            "x", f"{numeric.round_even('x')} AS two", f"{numeric.round_even('x', 1)} AS one",
            f"{numeric.fixed('x', 2)} AS text").collect():
        assert (r.two, r.one) == (round(r.x, 2), round(r.x, 1)), r.x
        assert Decimal(r.text) == Decimal(r.x).quantize(Decimal("0.01"), ROUND_HALF_UP), r.x


def test_rounding_of_no_numbers(value):
    assert math.isnan(value(numeric.round_even("CAST('NaN' AS double)")))
    assert value(numeric.round_even("CAST('-Infinity' AS double)")) == -math.inf
    assert value(numeric.round_even("CAST(NULL AS double)")) is None


def test_page_time_has_no_zone(spark, value):
    """Half past two does not exist in New York on this day."""
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            moment = "TIMESTAMP_NTZ '2024-03-10 02:30:05'"
            assert value(temporal.page_time(moment)) == "3/10/2024, 2:30:05 AM"
            assert value(temporal.page_time("TIMESTAMP_NTZ '2024-01-31 12:05:00'")) == "1/31/2024, 12:05:00 PM"
            assert value(temporal.page_time("TIMESTAMP_NTZ '2024-01-31 00:05:00'")) == "1/31/2024, 12:05:00 AM"
            assert value(temporal.epoch_seconds(moment)) == 1710037805
            assert value(temporal.epoch_seconds("TIMESTAMP_NTZ '1969-12-31 23:59:59.5'")) == -1
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
