from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from tests.fixtures import AS_OF, DAY, SEEDS, by_id, customers, mart, mart_row, telemetry
from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.upsert import insert_ignore, refresh_customers, upsert_mart
from usagemart.schemas import MART_COLUMNS


@pytest.fixture
def staged(spark):
    return to_mart_types(customer_mart(customers(spark), telemetry(spark), DAY, AS_OF))


def test_upsert_updates_three_and_inserts_two(spark, staged):
    rows = by_id(upsert_mart(mart(spark), staged, AS_OF))
    assert set(rows) == {1001, 1002, 1003, 1004, 1005}
    updated, inserted = rows[1001], rows[1004]
    assert updated.total_clicks == 155 and updated.load_date == DAY
    assert updated.created_at == datetime(2024, 1, 15, 2)
    assert inserted.created_at == AS_OF and inserted.registration_date == date(2023, 8, 5)
    assert {r.updated_at for r in rows.values()} == {AS_OF}


def test_registration_and_creation_are_kept_even_when_missing(spark):
    old = mart(spark, [mart_row(1, registered=None, created=None)])
    new = mart(spark, [mart_row(1, registered=date(2020, 1, 1), created=AS_OF)])
    row = upsert_mart(old, new, AS_OF).first()
    assert row.registration_date is None and row.created_at is None


def test_staged_nulls_overwrite(spark):
    new = mart(spark, [mart_row(1001, segment=None, value=None)])
    row = by_id(upsert_mart(mart(spark), new, AS_OF))[1001]
    assert row.segment is None and row.lifetime_value is None and row.email is None


def test_untouched_rows_stay(spark):
    new = mart(spark, [mart_row(7)])
    rows = by_id(upsert_mart(mart(spark), new, AS_OF))
    assert [tuple(rows[s[0]]) for s in SEEDS] == SEEDS


def test_same_batch_again_changes_only_updated_at(spark, staged):
    once = upsert_mart(mart(spark), staged, AS_OF)
    twice = upsert_mart(once, staged, AS_OF + timedelta(days=1))
    stable = [c for c in MART_COLUMNS if c != "updated_at"]
    assert once.select(stable).exceptAll(twice.select(stable)).isEmpty()
    assert {r.updated_at for r in twice.collect()} == {AS_OF + timedelta(days=1)}


def test_a_key_twice_in_a_batch_fails(spark):
    new = mart(spark, [mart_row(7), mart_row(7)])
    with pytest.raises(Exception, match="customer_id occurs twice in the batch: 7"):
        upsert_mart(mart(spark), new, AS_OF).collect()


def test_a_missing_key_fails(spark):
    with pytest.raises(Exception, match="customer_id is NULL in the batch"):
        upsert_mart(mart(spark), mart(spark, [mart_row(None)]), AS_OF).collect()


def test_insert_ignore(spark):
    new = mart(spark, [mart_row(1001, "other"), mart_row(8, "a"), mart_row(8, "b")])
    rows = insert_ignore(mart(spark), new).collect()
    assert sorted(r.customer_id for r in rows) == [8, 1001, 1002, 1003]
    assert {r.customer_id: r.segment for r in rows}[1001] == "premium"


def test_refresh_by_list_and_by_table(spark):
    ids = spark.createDataFrame([(1001,), (1001,), (5,)], "customer_id BIGINT")
    for chosen in ([1001, 5], ids):
        whole, changed = refresh_customers(mart(spark), chosen, AS_OF)
        assert whole.columns == MART_COLUMNS
        rows = by_id(whole)
        assert len(rows) == 3
        assert rows[1001].updated_at == AS_OF and rows[1001].load_date == AS_OF.date()
        assert tuple(rows[1002]) == SEEDS[1]
        assert [tuple(r) for r in changed.collect()] == [
            (1001, "ivan.ivanov@example.com", AS_OF.date(), AS_OF)]


def test_refresh_of_nobody(spark):
    whole, changed = refresh_customers(mart(spark), [], AS_OF)
    assert sorted(map(tuple, whole.collect())) == SEEDS and changed.isEmpty()
