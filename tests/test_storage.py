from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.fixtures import AS_OF, CUSTOMERS, DAY, SEEDS, customers, mart, mart_row, telemetry
from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.upsert import upsert_mart
from usagemart.schemas import DECLARED_MART_SCHEMA, MART_SCHEMA, STAGED_SCHEMA
from usagemart.session import scratch_path
from usagemart.sources import files
from usagemart.sources.audit import append_audit, audit_row, read_audit
from usagemart.sources.keyed_table import ConcurrentChange, KeyedTable
from usagemart.sources.staging import read_staging, write_staging
from usagemart.sources.tables import create_mart_table, write_bucketed


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "mart"), MART_SCHEMA, "customer_id", buckets=4)


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_new_table_is_empty(table):
    assert content(table) == []
    table.ensure()
    table.ensure()
    assert content(table) == [] and table.latest().number == 1


def test_replace_and_read(spark, table):
    table.replace(mart(spark))
    assert content(table) == SEEDS
    table.replace(mart(spark, SEEDS[:1]))
    assert content(table) == SEEDS[:1]


def test_replace_takes_a_new_number_of_buckets(spark, table):
    table.replace(mart(spark))
    before = table.read()
    again = KeyedTable(spark, table.root, MART_SCHEMA, "customer_id", buckets=16)
    assert again.buckets == 4 and content(again) == SEEDS
    again.replace(again.read())
    assert again.buckets == table.buckets == 16
    assert content(table) == SEEDS and sorted(map(tuple, before.collect())) == SEEDS
    touched = table.buckets_of(mart(spark, SEEDS[:1]))
    table.change(lambda current: current.where("customer_id <> 1001"), touched)
    assert content(table) == SEEDS[1:]


def test_of_two_writers_one_fails_and_may_run_again(spark, table):
    table.replace(mart(spark, [mart_row(i) for i in range(8)]))
    other = KeyedTable(spark, table.root, MART_SCHEMA, "customer_id", buckets=4)
    one, two = mart(spark, [mart_row(1, "one")]), mart(spark, [mart_row(2, "two")])

    def change(writer, staged, before=lambda: None):
        def transform(current):
            before()
            return upsert_mart(current, staged, AS_OF)
        writer.change(transform, writer.buckets_of(staged))

    with pytest.raises(ConcurrentChange):
        change(table, one, before=lambda: change(other, two))
    segments = {r.customer_id: r.segment for r in table.read().collect()}
    assert (segments[1], segments[2]) == ("standard", "two")
    change(table, one)
    segments = {r.customer_id: r.segment for r in table.read().collect()}
    assert (segments[1], segments[2], len(segments)) == ("one", "two", 8)


def test_a_change_starts_again_from_what_others_committed(spark, table):
    table.replace(mart(spark))
    other, meetings = KeyedTable(spark, table.root, table.schema, table.key, 4), iter(range(2))

    def transform(current):
        for i in meetings:
            other.change(lambda rows: upsert_mart(rows, mart(spark, [mart_row(i, "two")]), AS_OF))
            break
        return upsert_mart(current, mart(spark, [mart_row(1, "one")]), AS_OF)

    with pytest.raises(ConcurrentChange):
        table.change(transform, mart(spark, [mart_row(1)]))
    commit, buckets = table.change(transform, mart(spark, [mart_row(1)]), tries=2)
    assert commit == table.latest() and buckets == table.buckets_of(mart(spark, [mart_row(1)]))
    segments = {r.customer_id: r.segment for r in table.read().collect()}
    assert (segments[0], segments[1], len(segments)) == ("two", "one", 5)


def test_rows_survive_another_number_of_buckets_in_between(spark, table):
    table.replace(mart(spark))
    staged = mart(spark, [mart_row(i) for i in range(10)])
    named = table.buckets_of(staged)
    KeyedTable(spark, table.root, table.schema, table.key, 16).replace(table.read())
    # Named by the old number, buckets would miss rows: nothing is published.
    with pytest.raises(ValueError, match="named"):
        table.change(lambda current: upsert_mart(current, staged, AS_OF), named)
    assert content(table) == SEEDS
    others = iter([32])

    def transform(current):
        for buckets in others:
            KeyedTable(spark, table.root, table.schema, table.key, buckets).replace(table.read())
        return upsert_mart(current, staged, AS_OF)

    table.change(transform, staged, tries=2)
    assert table.buckets == 32 and len(content(table)) == 13


def test_a_dead_attempt_stays_unseen(spark, table):
    """Also when the session overwrites partitions dynamically."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        table.replace(mart(spark))

        def refuse(result, written):
            raise ValueError("no")

        with pytest.raises(ValueError):
            table.change(lambda current: mart(spark, [mart_row(i) for i in range(9)]), check=refuse)
        table.change(lambda current: current.where("customer_id = 1001"))
        assert content(table) == SEEDS[:1]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_reading_costs_the_same_after_many_commits(spark, table, monkeypatch):
    table.replace(mart(spark, SEEDS))
    for i in range(200):
        table._publish(table.latest(), table.latest().attempts, {"stream": i})
    looked = []
    look, read = files.exists, files.read_text
    monkeypatch.setattr(files, "exists", lambda *a: looked.append(a) or look(*a))
    monkeypatch.setattr(files, "read_text", lambda *a: looked.append(a) or read(*a))
    assert table.latest().number == 201 and table.committed("stream", 199)
    assert len(looked) <= 8 and content(table) == SEEDS
    files.remove(spark, f"{table.root}/commits/hint")
    assert table.latest().number == 201


def test_one_file_per_bucket(spark, table):
    table.replace(mart(spark, [mart_row(i) for i in range(200)]))
    files = table.read().select(F.input_file_name().alias("f"), table.bucket().alias("b"))
    assert files.distinct().count() == files.select("f").distinct().count() == 4


def test_change_rewrites_only_touched_buckets(spark, table):
    table.replace(mart(spark, [mart_row(i) for i in range(40)]))
    staged = mart(spark, [mart_row(3, "new")])
    touched = table.buckets_of(staged)
    assert len(touched) == 1
    table.change(lambda current: upsert_mart(current, staged, AS_OF), touched)
    rows = {r.customer_id: r for r in table.read().collect()}
    assert len(rows) == 40 and rows[3].segment == "new" and rows[4].segment == "standard"
    attempts = table.read().select(
        F.regexp_extract(F.input_file_name(), r"attempt=(\w+)", 1).alias("a"),
        table.bucket().alias("b")).distinct().groupBy("a").count().collect()
    assert sorted(r["count"] for r in attempts) == [1, 3]
    assert [r.bucket for r in table.expired().collect()] == touched


def test_a_bucket_may_become_empty(spark, table):
    table.replace(mart(spark))
    touched = table.buckets_of(mart(spark, SEEDS[:1]))
    table.change(lambda current: current.where("customer_id <> 1001"), touched)
    assert content(table) == SEEDS[1:]


def test_failed_check_publishes_nothing(spark, table):
    table.replace(mart(spark))

    def refuse(result, written):
        assert result.count() == 4 and written is None
        raise ValueError("no")

    staged = mart(spark, [mart_row(9)])
    with pytest.raises(ValueError):
        table.change(lambda current: upsert_mart(current, staged, AS_OF), check=refuse)
    assert content(table) == SEEDS
    table.change(lambda current: upsert_mart(current, staged, AS_OF))
    assert len(content(table)) == 4


def test_readers_keep_their_version(spark, table):
    table.replace(mart(spark))
    before = table.read()
    table.replace(mart(spark, []))
    assert before.count() == 3 and content(table) == []


def test_tags(spark, table):
    table.replace(mart(spark), tags={"stream": 3})
    table.replace(mart(spark))
    assert table.committed("stream", 3) and table.committed("stream", 2)
    assert not table.committed("stream", 4) and not table.committed("other", 0)


def test_nothing_touched_is_no_change(spark, table):
    table.replace(mart(spark))
    table.change(lambda current: current, touched=[])
    assert table.latest().number == 1
    table.change(lambda current: current, touched=[], tags={"stream": 1})
    assert table.latest().number == 2 and content(table) == SEEDS


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_staging_keeps_every_value(spark, tmp_path, fmt):
    odd = (7, "", ' "quoted", ', "a\nb", "c\\d", None, "2024-01-01", "\ttab ", 0.1 + 0.2)
    staged = customer_mart(customers(spark, [*CUSTOMERS, odd]), telemetry(spark), DAY, AS_OF)
    path = str(tmp_path / "staging")
    write_staging(staged, path, fmt)
    back = read_staging(spark, path, DAY, fmt)
    assert back.schema.fieldNames() == STAGED_SCHEMA.fieldNames()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, staged.collect()))


def test_staging_replaces_one_date(spark, tmp_path):
    path = str(tmp_path / "staging")
    people = customers(spark)
    for day, rows in [(date(2024, 1, 29), people), (DAY, people),
                      (DAY, people.where("customer_id = 1001"))]:
        write_staging(customer_mart(rows, telemetry(spark), day, AS_OF), path)
    assert read_staging(spark, path, DAY).count() == 1
    assert read_staging(spark, path).count() == 6
    plan = read_staging(spark, path, DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan


def test_audit_log(spark, tmp_path):
    path = str(tmp_path / "audit")
    start, end = datetime(2024, 1, 31, 2), datetime(2024, 1, 31, 2, 5)
    append_audit(audit_row(spark, "nightly_load", DAY, start, end, 5, "success"), path)
    append_audit(audit_row(spark, "nightly_load", DAY, start, end, 0, "failed", "why"), path)
    rows = sorted(read_audit(spark, path).collect(), key=lambda r: r.status)
    assert [(r.status, r.error_message, r.records_processed) for r in rows] == [
        ("failed", "why", 0), ("success", None, 5)]
    assert rows[0].audit_id != rows[1].audit_id and rows[0].end_time == end


def test_declared_table_checks_lengths(spark, tmp_path):
    create_mart_table(spark, "declared_mart", str(tmp_path / "declared"))
    create_mart_table(spark, "declared_mart", str(tmp_path / "declared"))
    try:
        described = {r.col_name: r for r in spark.sql("DESCRIBE declared_mart").collect()}
        assert described["first_name"].data_type == "varchar(100)"
        assert described["conversion_rate"].data_type == "decimal(5,2)"
        assert described["engagement_score"].comment
        to_mart_types(mart(spark).selectExpr(
            *(f"CAST({c} AS string) AS {c}" if c in ("registration_date", "load_date")
              else "date_format(created_at, \"yyyy-MM-dd'T'HH:mm:ss\") AS created_at"
              if c == "created_at" else c for c in mart(spark).columns)),
            DECLARED_MART_SCHEMA).write.insertInto("declared_mart")
        assert spark.table("declared_mart").count() == 3
        long_name = mart(spark, [mart_row(1, first="x" * 101)])
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
            long_name.write.insertInto("declared_mart")
    finally:
        spark.sql("DROP TABLE declared_mart")


def test_bucketed_sources_need_no_shuffle(spark, tmp_path):
    write_bucketed(customers(spark), "people_b", str(tmp_path / "p"), "customer_id", 4)
    write_bucketed(telemetry(spark), "telemetry_b", str(tmp_path / "t"), "customer_id", 4, "date")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        result = customer_mart(spark.table("people_b"), spark.table("telemetry_b"), DAY, AS_OF)
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert result.count() == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        spark.sql("DROP TABLE people_b")
        spark.sql("DROP TABLE telemetry_b")


def session_with(**conf):
    values = {key.replace("_", "."): value for key, value in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None:
                                                values.get(key, default)))


def test_scratch_is_the_folder_the_cluster_names():
    cluster = session_with(spark_master="spark://host", spark_checkpoint_dir="hdfs://shared/")
    assert scratch_path(cluster, "x").startswith("hdfs://shared/x-")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")


def test_scratch_is_never_local_to_a_machine_of_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(session_with(spark_master="spark://host"), "x")
    assert scratch_path(session_with(spark_master="local[8]"), "x")
