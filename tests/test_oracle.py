"""Every registered query against its SQL twin on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from tests.compare import spark_rows, sql_rows
from usagemart.catalog.queries import registered

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES, SQL = registered(), driver.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


# No result may depend on the session's zone.
ZONES = os.environ.get("ORACLE_ZONES", "UTC").split(",")
CASES = [(name, zone) for zone in ZONES for name in sorted(QUERIES)]
CASES += [(name, "America/New_York") for name in ("caller_info", "report_display", "access_decisions")
          if ZONES == ["UTC"]]


@pytest.fixture
def in_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name, zone", CASES)
def test_same_answer(spark, in_zone, name, zone):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_names, expected = sql_rows(FOLDER, SQL[name])
    assert names == expected_names
    assert rows
    missing, extra = list((expected - rows).items())[:3], list((rows - expected).items())[:3]
    assert not missing and not extra, f"missing {missing}\nextra {extra}"


def test_entry(spark):
    assert driver.entry(spark).count() > 0
