"""The nightly load, the refresh on demand, and the stream."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest

from tests.fixtures import (
    AS_OF, BEFORE, CUSTOMERS, DAY, TELEMETRY, by_id, customers, mart, telemetry)
from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.segments import segment_performance, top_engaged
from usagemart.plans.home import Home, read_mart
from usagemart.plans.nightly import run_nightly
from usagemart.plans.refresh import refresh_on_demand
from usagemart.schemas import MART_COLUMNS, TELEMETRY_SCHEMA
from usagemart.sources import files
from usagemart.sources.audit import read_audit
from usagemart.sources.keyed_table import KeyedTable
from usagemart.streaming.telemetry_stream import stream_upsert

STABLE = [c for c in MART_COLUMNS if c not in ("updated_at", "created_at")]


@pytest.fixture
def home(spark, tmp_path):
    return Home(spark, str(tmp_path / "home"), buckets=4)


def rows(df, columns=MART_COLUMNS):
    return sorted(map(tuple, df.select(columns).collect()))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_nightly(spark, home, fmt):
    home.mart.replace(mart(spark))
    result = run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF,
                         staging_format=fmt)
    found = by_id(result.mart)
    assert len(found) == 5 and found[1001].created_at == datetime(2024, 1, 15, 2)
    assert result.extracted.first().records_count == 12
    assert result.issues.first().is_valid
    assert result.violations.where("violations > 0").isEmpty()
    assert {r.segment for r in result.report.collect()} == {"premium", "enterprise", "standard"}
    assert sum(r.customer_count for r in result.segment_performance.collect()) == 5
    audit = read_audit(spark, home.audit).first()
    assert (audit.status, audit.records_processed) == ("success", 5)
    assert rows(read_mart(spark, home.root)) == rows(result.mart)
    assert spark.read.parquet(home.reports).count() == 3


def test_second_run_is_idempotent(spark, home):
    first = run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF)
    before = rows(first.mart, STABLE)
    again = run_nightly(home, customers(spark), telemetry(spark), DAY,
                        AS_OF + timedelta(hours=1))
    assert rows(again.mart, STABLE) == before
    assert spark.read.parquet(home.reports).count() == 3


def test_shared_email_fails_the_run_and_changes_nothing(spark, home):
    run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF)
    before = rows(home.mart.read())
    twin = (2001, *CUSTOMERS[0][1:])
    with pytest.raises(ValueError, match="email is not unique: ivan.ivanov@example.com"):
        run_nightly(home, customers(spark, [*CUSTOMERS, twin]), telemetry(spark), DAY, AS_OF)
    assert rows(home.mart.read()) == before
    failed = read_audit(spark, home.audit).where("status = 'failed'").first()
    assert "not unique" in failed.error_message


def test_duplicate_customer_fails_the_run(spark, home):
    with pytest.raises(Exception, match="occurs twice"):
        run_nightly(home, customers(spark, [*CUSTOMERS, CUSTOMERS[0]]), telemetry(spark), DAY,
                    AS_OF)
    assert home.mart.read().isEmpty()


def test_issues_only_warn(spark, home):
    nameless = (7, *CUSTOMERS[0][1:3], None, *CUSTOMERS[0][4:])
    result = run_nightly(home, customers(spark, [nameless]), telemetry(spark), DAY, AS_OF)
    assert result.issues.first().issues == ["Found 1 records with null emails"]
    with pytest.raises(Exception, match="null emails"):
        run_nightly(home, customers(spark, [nameless]), telemetry(spark), DAY, AS_OF, strict=True)


def test_refresh_stamps_and_logs(spark, home):
    home.mart.replace(mart(spark))
    result = refresh_on_demand(home, [1001, 4242], AS_OF)
    assert [tuple(r) for r in result.collect()] == [
        (1001, "ivan.ivanov@example.com", AS_OF.date(), AS_OF)]
    found = by_id(home.mart.read())
    assert found[1001].total_clicks == 2450 and found[1002].load_date == date(2024, 1, 15)
    entry = read_audit(spark, home.audit).first()
    assert (entry.process_name, entry.records_processed) == ("manual_report_generation", 1)
    performance = {r.segment: r for r in home.segment_performance().collect()}
    assert performance["premium"].last_update_date == AS_OF.date()


def test_refresh_can_recompute(spark, home):
    home.mart.replace(mart(spark))
    refresh_on_demand(home, [1001, 1004], AS_OF, customers(spark), telemetry(spark))
    found = by_id(home.mart.read())
    assert set(found) == {1001, 1002, 1003}
    assert found[1001].total_clicks == 155 and found[1002].total_clicks == 6200
    assert found[1001].created_at == datetime(2024, 1, 15, 2)


def test_refresh_refuses_an_email_that_another_bucket_holds(spark, home):
    home.mart.replace(mart(spark))
    before = rows(home.mart.read())
    moved = (*CUSTOMERS[0][:3], CUSTOMERS[1][3], *CUSTOMERS[0][4:])
    with pytest.raises(ValueError, match="email is not unique: maria.petrova@example.com"):
        refresh_on_demand(home, [1001], AS_OF, customers(spark, [moved]), telemetry(spark))
    assert rows(home.mart.read()) == before


def test_a_refresh_during_the_load_and_the_load_both_count(spark, home, monkeypatch):
    home.mart.replace(mart(spark))
    later, stage, met = AS_OF + timedelta(minutes=5), KeyedTable._stage, []

    def staged_slowly(table, *args):
        if not met:
            met.append(True)
            refresh_on_demand(Home(spark, home.root, buckets=4), [1002], later)
        return stage(table, *args)

    monkeypatch.setattr(KeyedTable, "_stage", staged_slowly)
    result = run_nightly(home, customers(spark, [c for c in CUSTOMERS if c[0] != 1002]), telemetry(spark), DAY, AS_OF)
    found = by_id(result.mart)
    assert met and len(found) == 5 and found[1002].updated_at == later and found[1001].updated_at == AS_OF
    assert sum(r.customer_count for r in result.segment_performance.collect()) == 5
    assert read_audit(spark, home.audit).where("status = 'success'").count() == 2


def test_views(spark, home):
    run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF)
    home.create_views()
    assert spark.sql("SELECT count(*) FROM customer_data_mart").first()[0] == 5
    assert spark.sql("SELECT sum(customer_count) FROM segment_performance").first()[0] == 5


def start_stream(spark, home, folder, checkpoint):
    source = (spark.readStream.schema(TELEMETRY_SCHEMA).option("maxFilesPerTrigger", 1)
              .parquet(folder))
    query = stream_upsert(source, customers(spark), home, checkpoint,
                          execution_date=lambda: DAY, clock=lambda: AS_OF)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch(spark, home, tmp_path):
    """Three batches; the last brings a day long past and a second part of a day."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    late = (1002, date(2024, 1, 2), 60, 10, 4, 1)
    more = (1001, DAY, 5, 1, 1, 0)
    stranger = (9, DAY, 1, 1, 1, 1)
    everything = [*TELEMETRY, late, more, stranger]
    idle = customer_mart(customers(spark), telemetry(spark, []), DAY, AS_OF)
    home.mart.replace(to_mart_types(idle))
    for part in (TELEMETRY[:3], TELEMETRY[3:], [late, more, stranger]):
        telemetry(spark, part).coalesce(1).write.mode("append").parquet(folder)
    start_stream(spark, home, folder, checkpoint)
    daily = [(1001, DAY, 50, 121, 86, 2), (1001, BEFORE, 38, 95, 70, 1), late, *TELEMETRY[2:]]
    batch = to_mart_types(customer_mart(customers(spark), telemetry(spark, daily), DAY, AS_OF, 30))
    assert len(everything) == len(daily) + 2
    assert rows(home.mart.read(), STABLE) == rows(batch, STABLE)
    assert sorted(map(tuple, home.segment_performance().collect())) == sorted(
        map(tuple, segment_performance(home.mart.read()).collect()))

    # Nothing new: nothing changes.
    before = home.mart.latest().number
    start_stream(spark, home, folder, checkpoint)
    assert home.mart.latest().number == before


def test_a_new_checkpoint_starts_over_and_counts_once(spark, home, tmp_path):
    folder = str(tmp_path / "in")
    telemetry(spark).coalesce(1).write.parquet(folder)
    start_stream(spark, home, folder, str(tmp_path / "checkpoint"))
    once = rows(home.mart.read())
    start_stream(spark, home, folder, str(tmp_path / "another"))
    assert rows(home.mart.read()) == once
    more = (1001, DAY, 5, 1, 1, 0)
    telemetry(spark, [more]).coalesce(1).write.mode("append").parquet(folder)
    start_stream(spark, home, folder, str(tmp_path / "another"))
    assert by_id(home.mart.read())[1001].total_clicks == 156


def test_crash_between_the_two_commits_is_repaired(spark, home, tmp_path, monkeypatch):
    """The history has the batch already, the mart has not."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    telemetry(spark).coalesce(1).write.parquet(folder)

    def lost(mart, written=None):
        raise RuntimeError("lost")

    monkeypatch.setattr("usagemart.streaming.telemetry_stream.mart_gate", lost)
    with pytest.raises(Exception, match="lost"):
        start_stream(spark, home, folder, checkpoint)
    monkeypatch.undo()
    assert home.mart.read().isEmpty()
    start_stream(spark, home, folder, checkpoint)
    expected = to_mart_types(
        customer_mart(customers(spark), telemetry(spark), DAY, AS_OF, 30))
    # Customers without telemetry have not been seen by the stream.
    seen = {r[0] for r in TELEMETRY}
    assert rows(home.mart.read(), STABLE) == [r for r in rows(expected, STABLE) if r[0] in seen]
    assert home.mart.latest().number == 1


def test_the_window_moves_for_silent_customers(spark, home, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    days = [date(2024, 1, 1), date(2024, 3, 1), date(2024, 2, 1)]
    everything = [(1001, days[0], 10, 5, 5, 1), (1002, days[1], 10, 4, 4, 1),
                  (1003, days[2], 3, 2, 2, 0)]
    for row in everything:
        telemetry(spark, [row]).coalesce(1).write.mode("append").parquet(folder)
    ends = iter([date(2024, 1, 1), date(2024, 3, 1), date(2024, 3, 2)])
    source = (spark.readStream.schema(TELEMETRY_SCHEMA).option("maxFilesPerTrigger", 1)
              .parquet(folder))
    idle = customer_mart(customers(spark), telemetry(spark, []), DAY, AS_OF)
    home.mart.replace(to_mart_types(idle))
    query = stream_upsert(source, customers(spark), home, checkpoint,
                          execution_date=lambda: next(ends), clock=lambda: AS_OF)
    query.awaitTermination()
    batch = customer_mart(customers(spark), telemetry(spark, everything), date(2024, 3, 2), AS_OF, 30)
    metrics = ["customer_id", "total_clicks", "total_conversions", "active_days"]
    assert rows(home.mart.read(), metrics) == rows(to_mart_types(batch), metrics)
    assert by_id(home.mart.read())[1001].total_clicks == 0


def test_a_long_error_is_kept_whole(spark, home):
    text = "x" * 5_000
    with pytest.raises(Exception):
        run_nightly(home, customers(spark).where(f"raise_error('{text}') IS NULL"), telemetry(spark), DAY, AS_OF)
    assert text in read_audit(spark, home.audit).first().error_message


def test_an_empty_delivery_has_a_report(spark, home):
    result = run_nightly(home, customers(spark, []), telemetry(spark, []), DAY, AS_OF)
    line = result.report.first()
    assert (line.total_records, line.segment, line.line, line.quality) == (0, None, None, "PASS")
    assert spark.read.parquet(home.reports).count() == 1


def test_a_refresh_filters_every_scan_by_its_ids(spark, home, monkeypatch):
    home.mart.replace(mart(spark))
    people = home.root + "-people"
    customers(spark).write.parquet(people)
    tel = home.root + "-tel"
    telemetry(spark).write.parquet(tel)
    plans = []
    stage = KeyedTable._stage

    def spying(self, rows, buckets):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return stage(self, rows, buckets)

    monkeypatch.setattr(KeyedTable, "_stage", spying)
    refresh_on_demand(home, [1001], AS_OF, spark.read.parquet(people), spark.read.parquet(tel))
    scans = [line for line in plans[0].splitlines() if "FileScan" in line]
    assert len(scans) >= 4
    unfiltered = [line for line in scans if "EqualTo(customer_id,1001)" not in line]
    # Only the rewritten bucket itself is read whole.
    assert len(unfiltered) == 1 and "bucket#" in unfiltered[0]


def test_a_few_emails_are_looked_up_by_pushed_filters(spark, home, monkeypatch):
    home.mart.replace(mart(spark))
    plans = []
    monkeypatch.setattr("usagemart.plans.home.require_unique", lambda df, *keys: plans.append(
        (keys, df._jdf.queryExecution().executedPlan().toString())))
    refresh_on_demand(home, [1001], AS_OF, customers(spark), telemetry(spark))
    (_, _), (keys, text) = plans
    assert keys == ("email",) and "EqualTo(email,ivan.ivanov@example.com)" in text and "Join" not in text


def test_jobs_leave_no_scratch_but_what_they_return(spark, home, tmp_path, monkeypatch):
    base = tmp_path / "shared"
    monkeypatch.setattr("usagemart.session.shared_folder", lambda spark: str(base))
    result = run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF)
    assert len(list(base.iterdir())) == 1 and result.extracted.first().customers == 5
    ids = spark.createDataFrame([(1001,), (1002,)], "customer_id bigint")
    refreshed = refresh_on_demand(home, ids, AS_OF + timedelta(hours=1))
    assert len(list(base.iterdir())) == 2 and refreshed.count() == 2
    inbox, arrived = str(tmp_path / "inbox"), telemetry(spark)
    arrived.write.parquet(inbox)
    stream = spark.readStream.schema(arrived.schema).parquet(inbox)
    stream_upsert(stream, customers(spark), home, str(tmp_path / "checkpoint"), lambda: DAY, lambda: AS_OF).awaitTermination()
    assert len(list(base.iterdir())) == 2


def test_a_failed_job_leaves_no_scratch(spark, home, tmp_path, monkeypatch):
    base = tmp_path / "shared"
    monkeypatch.setattr("usagemart.session.shared_folder", lambda spark: str(base))
    with pytest.raises(Exception):
        run_nightly(home, customers(spark, [*CUSTOMERS, CUSTOMERS[0]]), telemetry(spark), DAY, AS_OF)
    assert not base.exists() or not list(base.iterdir())


def test_the_leaderboard_reads_the_leaders_of_buckets(spark, home):
    run_nightly(home, customers(spark), telemetry(spark), DAY, AS_OF)
    refresh_on_demand(home, [1001], AS_OF + timedelta(hours=1))
    board = home.top_engaged(3)
    assert rows(board, ["customer_id", "engagement_score"]) == rows(
        top_engaged(home.mart.read(), 3), ["customer_id", "engagement_score"]) and board.count() == 3
    assert board.inputFiles() and all("/leaders/" in path for path in board.inputFiles())
    # More than buckets keep, or buckets without leaders: the mart itself.
    assert not any("/leaders/" in path for path in home.top_engaged(1_000).inputFiles())
    for attempt in {*home.mart.latest().attempts}:
        files.remove(spark, f"{home.mart.root}/leaders/attempt={attempt}")
    assert home.top_engaged(3).count() == 3
