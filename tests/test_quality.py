from __future__ import annotations

from datetime import date

import pytest

from tests.fixtures import AS_OF, CUSTOMERS, DAY, customers, mart, mart_row, telemetry
from usagemart.operators.mart import customer_mart
from usagemart.operators.quality import (
    dq_checks, dq_issues, duplicate_keys, run_report, type_violations)
from usagemart.plans.home import require_unique

BAD = [mart_row(1, email="x"), mart_row(2, minutes="-1"), mart_row(3, engagement="-0.01"),
       mart_row(4, clicks=0, conversions=3, email="y", loaded=date(2024, 2, 1))]


def test_clean_mart(spark):
    checks = dq_checks(mart(spark))
    assert tuple(checks.first()) == (3, 0, 0, date(2024, 1, 15), date(2024, 1, 15), 0)
    row = dq_issues(checks, strict=True).first()
    assert (row.issues, row.is_valid, row.total_records) == ([], True, 3)


def test_each_check_fires(spark):
    checks = dq_checks(mart(spark, BAD))
    assert tuple(checks.first()) == (4, 2, 2, date(2024, 2, 1), date(2024, 1, 15), 1)
    row = dq_issues(checks).first()
    assert row.issues == ["Found 2 records with null emails",
                          "Found 2 records with negative values"]
    assert not row.is_valid


def test_strict_fails(spark):
    with pytest.raises(Exception, match="Found 2 records with null emails"):
        dq_issues(dq_checks(mart(spark, BAD)), strict=True).collect()


def test_empty_mart_is_valid(spark):
    row = dq_issues(dq_checks(mart(spark, []))).first()
    assert (row.is_valid, row.total_records) == (True, 0)


def test_duplicate_keys(spark):
    frame = mart(spark, [mart_row(1, email="x"), mart_row(2, email="x"), mart_row(2)])
    assert [tuple(r) for r in duplicate_keys(frame, "customer_id").collect()] == [(2, 2)]
    assert [tuple(r) for r in duplicate_keys(frame, "email").collect()] == [("x", 2)]
    with pytest.raises(ValueError, match="customer_id is not unique: 2"):
        require_unique(frame, "customer_id", "email")
    require_unique(mart(spark), "customer_id", "email")


def test_type_violations(spark):
    def customer(**changed):
        names = ["customer_id", "first_name", "last_name", "email", "company", "segment",
                 "registration_date", "status", "lifetime_value"]
        return tuple((dict(zip(names, CUSTOMERS[0])) | changed).values())

    people = customers(spark, [
        customer(), customer(customer_id=3_000_000_000), customer(first_name="x" * 101),
        customer(registration_date="yesterday"), customer(lifetime_value=1e10)])
    staged = customer_mart(people, telemetry(spark, [(1001, DAY, 1, 1, 1, 50)]), DAY, AS_OF)
    found = {r["column"]: r.violations for r in type_violations(staged).collect()}
    assert len(found) == 19
    assert {c: n for c, n in found.items() if n} == {
        "customer_id": 1, "first_name": 1, "registration_date": 1, "lifetime_value": 1,
        "conversion_rate": 4}


def test_run_report(spark):
    rows = run_report(mart(spark, [*BAD, mart_row(5, None, "2.12"),
                                     mart_row(6, None, "2.13")]), DAY).collect()
    lines = {r.segment: r for r in rows}
    assert set(lines) == {"standard", "None"}
    assert lines["None"].line == "None: 2 records (avg engagement: 2.12)"
    assert lines["standard"].line == "standard: 4 records (avg engagement: 7.50)"
    assert {(r.execution_date, r.status, r.total_records, r.issues_found, r.quality)
            for r in rows} == {("2024-01-30", "SUCCESS", 6, 2, "WARNINGS")}
    assert {r.quality for r in run_report(mart(spark), DAY).collect()} == {"PASS"}
