from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from tests.fixtures import (
    AS_OF, BEFORE, CUSTOMERS, DAY, GOLDEN_METRICS, TELEMETRY, by_id, customers, telemetry)
from usagemart.operators.mart import (
    customer_mart, extract_metrics, load_metadata, sample_rows, to_mart_types)
from usagemart.operators.telemetry import daily_rollup, telemetry_agg
from usagemart.schemas import DECLARED_MART_SCHEMA, MART_COLUMNS, MART_SCHEMA, STAGED_SCHEMA
from usagemart.sources.readers import jdbc_source, read_customers, read_telemetry


def test_golden_metrics(spark):
    rows = telemetry_agg(telemetry(spark)).orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == GOLDEN_METRICS


def test_active_days_count_rows_with_a_duration(spark):
    rows = [(1, DAY, None, 1, 1, 0), (1, DAY, 10, 1, 1, 0), (1, DAY, 20, None, 1, 0)]
    row = telemetry_agg(telemetry(spark, rows)).first()
    assert (row.active_days, row.total_session_minutes, row.avg_session_minutes) == (2, 30, 15.0)


def test_customer_with_no_duration_at_all(spark):
    row = telemetry_agg(telemetry(spark, [(1, DAY, None, 2, 0, 0)])).first()
    assert (row.total_session_minutes, row.avg_session_minutes, row.active_days) == (0, None, 0)
    assert row.engagement_score == 0.4


def test_window_keeps_the_last_days(spark):
    rows = [(1, date(2024, 1, 1), 1, 0, 0, 0), (1, date(2023, 12, 31), 10, 0, 0, 0),
            (1, DAY, 100, 0, 0, 0), (1, date(2024, 1, 31), 1000, 0, 0, 0)]
    row = telemetry_agg(telemetry(spark, rows), DAY, 30).first()
    assert row.total_session_minutes == 101


def test_left_join_keeps_customers_and_drops_strangers(spark):
    tel = telemetry(spark, [*TELEMETRY[:1], (9, DAY, 1, 1, 1, 1), (None, DAY, 1, 1, 1, 1)])
    rows = by_id(customer_mart(customers(spark), tel, DAY, AS_OF))
    assert set(rows) == {c[0] for c in CUSTOMERS}
    assert rows[1001].total_clicks == 85
    assert rows[1002].total_clicks == 0 and rows[1002].engagement_score == 0.0
    assert rows[1002].load_date == "2024-01-30"
    assert rows[1002].created_at == "2024-01-31T00:00:00"


def test_zero_fill_leaves_text_alone(spark):
    bare = customers(spark, [(1, None, None, None, None, None, None, None, None)])
    row = customer_mart(bare, telemetry(spark), DAY, AS_OF).first()
    assert row.lifetime_value == 0.0 and row.avg_session_minutes == 0.0
    assert row.email is None and row.segment is None and row.registration_date is None


def test_a_value_that_is_not_a_number_counts_as_missing(spark):
    row = (*CUSTOMERS[0][:8], float("nan"))
    staged = customer_mart(customers(spark, [row]), telemetry(spark), DAY, AS_OF)
    assert staged.first().lifetime_value == 0.0


def test_metadata(spark):
    nameless = (7, *CUSTOMERS[0][1:5], None, *CUSTOMERS[0][6:])
    staged = customer_mart(customers(spark, [*CUSTOMERS, nameless]), telemetry(spark), DAY, AS_OF)
    row = load_metadata(staged).first()
    assert (row.row_count, row.columns) == (6, STAGED_SCHEMA.fieldNames())
    assert row.customer_segments == {"premium": 2, "enterprise": 2, "standard": 1}
    assert load_metadata(staged.where("false")).first().customer_segments == {}


def test_extract_counts(spark):
    row = extract_metrics(customers(spark), telemetry(spark), AS_OF).first()
    assert tuple(row) == (5, 7, 12, "2024-01-31T00:00:00")


def test_typed_mart(spark):
    staged = customer_mart(customers(spark), telemetry(spark), DAY, AS_OF)
    typed = to_mart_types(staged)
    assert typed.columns == MART_COLUMNS
    assert [f.dataType for f in typed.schema] == [f.dataType for f in MART_SCHEMA]
    assert typed.schema["engagement_score"].metadata["comment"]
    row = by_id(typed)[1001]
    assert row.registration_date == date(2023, 1, 15) and row.load_date == DAY
    assert row.created_at == AS_OF and row.updated_at is None
    assert row.lifetime_value == Decimal("15000.50")


def test_declared_types_refuse_what_does_not_fit(spark):
    tel = telemetry(spark, [(1001, DAY, 1, 1, 1, 50)])
    staged = customer_mart(customers(spark), tel, DAY, AS_OF)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        to_mart_types(staged, DECLARED_MART_SCHEMA).collect()
    assert by_id(to_mart_types(staged))[1001].conversion_rate == Decimal("5000.00")


def test_junk_registration_date_becomes_null(spark):
    row = list(CUSTOMERS[0])
    row[6] = "15/01/2023"
    staged = customer_mart(customers(spark, [tuple(row)]), telemetry(spark), DAY, AS_OF)
    assert to_mart_types(staged).first().registration_date is None


def test_sample(spark):
    assert [r.customer_id for r in sample_rows(customers(spark)).collect()] == [1001, 1002, 1003]


def test_daily_rollup_adds_rows_of_a_day(spark):
    rows = [(1, DAY, 10, 1, 0, 0), (1, DAY, 5, 1, 2, 0), (1, BEFORE, 1, 0, 0, 0)]
    result = {r.date: r for r in daily_rollup(telemetry(spark, rows)).collect()}
    assert (result[DAY].session_duration_minutes, result[DAY].clicks) == (15, 2)
    assert result[BEFORE].session_duration_minutes == 1


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_readers_take_any_format(spark, tmp_path, fmt):
    people, tel = str(tmp_path / "people"), str(tmp_path / "tel")
    options = {"header": "true"} if fmt == "csv" else {}
    customers(spark).write.format(fmt).options(**options).save(people)
    older = (1001, date(2024, 1, 28), 1, 1, 1, 1)
    telemetry(spark, [*TELEMETRY, older]).write.format(fmt).options(**options).save(tel)
    read = read_customers(spark, {"format": fmt, "path": people, **options})
    assert sorted(map(tuple, read.collect())) == CUSTOMERS
    window = read_telemetry(spark, {"format": fmt, "path": tel, **options}, DAY)
    assert sorted(map(tuple, window.collect())) == sorted(TELEMETRY)


def test_jdbc_source_is_split():
    source = jdbc_source("jdbc:db", "customers", "customer_id", 0, 1000, 50, fetchsize="10000")
    assert source["numPartitions"] == "50" and source["partitionColumn"] == "customer_id"
    assert source["format"] == "jdbc" and source["fetchsize"] == "10000"
