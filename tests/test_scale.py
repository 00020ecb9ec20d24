"""What the plans must look like for tables a million times larger, and skewed ones."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

from tests.fixtures import AS_OF, DAY, claims, mart, mart_row
from usagemart.catalog.queries import registered
from usagemart.operators import access, quality, reports, segments, telemetry, upsert
from usagemart.plans.home import Home
from usagemart.sources import warehouse
from usagemart.sources.dimensions import segment_dim

FOLDER = "/root/testdata/sf0.001"
QUERIES = registered()
# These write tables while they are built; their parts are covered by the others.
JOBS = {"mart_scan", "csv_round_trip", "nightly_run", "nightly_run_performance", "nightly_run_report",
        "refresh_run", "refresh_run_performance", "stream_telemetry_agg", "stream_performance",
        "audit_log", "access_filter", "report_envelope"}


@contextmanager
def settings(spark, **values):
    keys = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def large(spark, adaptive="false"):
    """Plan as if no side were small enough to broadcast."""
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                    spark__sql__adaptive__enabled=adaptive)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_plan_multiplies_or_leaves_the_jvm(spark, name):
    with large(spark):
        text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Broadcast"):
        assert bad not in text


def test_aggregates_shrink_before_every_shuffle(spark):
    with large(spark):
        lines = plan(QUERIES["telemetry_agg"](spark, FOLDER)).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert all("partial_sum" in lines[i + 1] for i in exchanges)


def test_join_reuses_the_shuffle_of_the_aggregates(spark):
    """Customers and nations meet by nation; then customers, orders and events, which are summed
    by day first, are shuffled by customer once each."""
    with large(spark):
        text = plan(QUERIES["customer_mart"](spark, FOLDER))
    assert text.count("Exchange hashpartitioning") == 6
    assert len(re.findall(r"hashpartitioning\((c_custkey|customer_id)#\d+L, 8\)", text)) == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(warehouse.telemetry(spark, FOLDER, DAY, 2))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" \
        in scan
    assert "GreaterThanOrEqual(ts,2024-01-29T00:00)" in scan
    assert "LessThan(ts,2024-01-31T00:00)" in scan


@pytest.fixture
def stored(spark, tmp_path):
    home = Home(spark, str(tmp_path / "home"), buckets=8)
    home.mart.replace(mart(spark, [mart_row(i, email=f"u{i}") for i in range(100)]))
    return home


def test_checks_read_six_columns_once(spark, stored):
    text = plan(quality.dq_checks(stored.mart.read()))
    assert text.count("FileScan") == 1
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert set(re.findall(r"(\w+)#", columns)) == {
        "email", "total_session_minutes", "engagement_score", "load_date", "total_conversions",
        "total_clicks", "attempt", "bucket"}


def test_a_few_ids_become_a_pushed_filter(spark, stored):
    changed = upsert.refresh_customers(stored.mart.read(), [3, 4], AS_OF)[1]
    text = plan(changed)
    assert "PushedFilters: [In(customer_id, [3,4])]" in text and "Exchange" not in text


def test_buckets_prune_folders(spark, stored):
    text = plan(stored.mart.read([2]))
    assert "bucket" in re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert stored.mart.read([2]).inputFiles() and stored.mart.read([2]).count() < 100


def test_upsert_shuffles_each_side_once(spark, stored):
    table = stored.mart
    with large(spark), settings(spark, spark__sql__shuffle__partitions="200"):
        staged = table.spread(table.read())
        text = plan(upsert.upsert_mart(table.spread(table.read()), staged, AS_OF))
    assert text.count("Exchange hashpartitioning(customer_id") + text.count("ReusedExchange") == 2


def test_insert_ignore_keeps_one_row_per_key_before_the_shuffle(spark, stored):
    with large(spark):
        text = plan(upsert.insert_ignore(stored.mart.read(), mart(spark, [mart_row(1)] * 3)))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_equal_timestamps_spread_over_the_sort(spark):
    """All rows lack the timestamp; ordering by it alone would leave them in one partition."""
    with settings(spark, spark__sql__adaptive__enabled="false"):
        frame = spark.range(20_000).selectExpr(
            "id AS customer_id", "CAST(NULL AS timestamp_ntz) AS updated_at")
        parts = reports.order_reports(frame).selectExpr(
            "spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 10_000


SKEW = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "200KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__shuffle__partitions": "16",
}


@pytest.fixture
def busy_caller(spark):
    """A third of all requests comes from one caller, half of them for somebody else."""
    profiles = spark.range(5_000).selectExpr("id AS customer_id", "concat('u', id) AS email")
    requests = spark.range(0, 900_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 'u5', concat('u', id % 10000)) AS email",
        "CAST(NULL AS string) AS preferred_username",
        "if(id % 2 = 0, 5, NULL) AS requested_customer_id")
    return requests, profiles


def test_a_busy_caller_is_split(spark, busy_caller):
    with large(spark, "true"), settings(spark, **SKEW):
        decisions = access.access_decisions(*busy_caller).groupBy("decision").count()
        found = {r["decision"]: r["count"] for r in decisions.collect()}
        assert "SortMergeJoin(skew=true)" in plan(decisions)
        allowed = access.allowed_customers(access.access_decisions(*busy_caller))
        assert len(allowed.collect()) > 0
        assert "SortMergeJoin(skew=true)" in plan(allowed)
    # The same by arithmetic.
    expected = {"allowed": 0, "denied_other": 0, "no_profile": 0}
    for i in range(900_000):
        own = 5 if i % 3 == 0 else i % 10_000
        if own >= 5_000:
            expected["no_profile"] += 1
        elif i % 2 == 0 and own != 5:
            expected["denied_other"] += 1
        else:
            expected["allowed"] += 1
    assert found == expected


def test_a_busy_customer_is_summed_right(spark):
    rows = spark.range(0, 600_000, 1, 16).selectExpr(
        "if(id % 3 = 0, 0, id % 1000) AS customer_id", "DATE '2024-01-30' AS date",
        "id % 7 AS session_duration_minutes", "1L AS page_views", "id % 2 AS clicks",
        "0L AS conversions")
    row = telemetry.telemetry_agg(rows).where("customer_id = 0").first()
    ids = [i for i in range(600_000) if i % 3 == 0 or i % 1000 == 0]
    assert row.total_session_minutes == sum(i % 7 for i in ids)
    assert row.active_days == row.total_page_views == len(ids)
    assert row.total_clicks == sum(i % 2 for i in ids)


def test_nameless_requests_bypass_the_join(spark):
    frame = claims(spark, [(None, None, None), ("u1", None, None)])
    with large(spark):
        text = plan(access.access_decisions(frame, mart(spark, [mart_row(1, email="u1")])))
    assert text.startswith("Union")


def test_the_dimension_is_broadcast_by_its_known_size(spark, stored):
    with settings(spark, spark__sql__adaptive__enabled="false"):
        frame = stored.mart.read()
        text = plan(segments.customer_analytics(frame, segment_dim(spark), AS_OF))
        assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("name", ["customer_report", "reports_ordered", "report_display", "report_json",
                                  "customer_report_nested", "report_envelope", "customer_summary"])
def test_reports_compile(spark, name):
    """Code beyond the limits of the JVM would be interpreted, with no more than a line in the log."""
    before = {key: spark.conf.get(key, None) for key in ("spark.sql.codegen.fallback", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        assert QUERIES[name](spark, FOLDER).collect()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
