"""Telemetry stream -> daily sums -> mart.

Each micro-batch is summed per customer and day and added to a history table, then customers are
aggregated again from that history and upserted: those the batch mentions, and, when the window has moved
since the last batch, those with telemetry on a day that left or entered it. Telemetry that arrives late
is counted whenever it comes, where a watermark would drop it, and no state grows in the executors.

The history is a keyed table by customer: a batch reads and writes only the buckets of its customers, and
nothing has to list earlier batches. Every step is committed with the number of the batch, and a batch that
runs twice skips what it has committed, so nothing counts twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StreamingQuery

from usagemart.functions.temporal import date_literal
from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.telemetry import daily_rollup, telemetry_partials
from usagemart.operators.upsert import KEY, upsert_mart
from usagemart.plans.home import TRIES, Home, mart_gate
from usagemart.session import materialize, scratch_scope
from usagemart.sources.keyed_table import KeyedTable

HISTORY = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("session_duration_minutes", T.DecimalType(28, 2)),
    T.StructField("page_views", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("conversions", T.LongType()),
])


def moved_days(before: date, now: date, window_days: int) -> str:
    """Condition on ``date``: the day left or entered the window as its end went from one day to another."""
    low, high = sorted((before, now))
    back = timedelta(days=window_days)
    day = date_literal
    return (f"(date > {day(low - back)} AND date <= {day(high - back)})"
            f" OR (date > {day(low)} AND date <= {day(high)})")


def stream_upsert(telemetry: DataFrame, customers: DataFrame, home: Home, checkpoint: str,
                  execution_date: Callable[[], date], clock: Callable[[], datetime],
                  window_days: int | None = 30, **trigger) -> StreamingQuery:
    """Start the stream. ``telemetry`` is a streaming DataFrame in the telemetry columns; several
    rows per customer and day are added up. ``trigger`` goes to ``DataStreamWriter.trigger``.

    Batch numbers belong to a checkpoint, and so does the history: a stream that starts over with
    a new checkpoint reads its input from the start and builds a history of its own.
    """
    spark = home.spark
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()
    past = KeyedTable(spark, f"{home.root}/telemetry_days/{stream}", HISTORY, KEY, home.buckets)
    seen_until = f"{stream}/date"

    def add_to_history(batch: DataFrame, batch_id: int) -> None:
        new = materialize(telemetry_partials(batch.where(f"{KEY} IS NOT NULL")).select(
            *HISTORY.fieldNames()).to(HISTORY), "batch")
        past.change(lambda days: past.spread(telemetry_partials(days.unionByName(new)).select(
            *HISTORY.fieldNames()).to(HISTORY)), new, tags={stream: batch_id})

    def absorb(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            upsert(batch, batch_id)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        mart, until = home.mart, execution_date()
        if mart.committed(stream, batch_id):
            return
        changed = batch.select(KEY).where(f"{KEY} IS NOT NULL").distinct()
        if not past.committed(stream, batch_id):
            add_to_history(batch, batch_id)
        days = past.latest()
        history = past.read(at=days)
        last = mart.latest().tags.get(seen_until)
        if window_days is not None and last is not None and last != until.toordinal():
            moved = history.where(moved_days(date.fromordinal(last), until, window_days))
            changed = changed.unionByName(moved.select(KEY)).distinct()
        affected = materialize(changed, "customers")
        as_of = clock()
        daily = daily_rollup(past.read(past.buckets_of(affected, days), days).join(affected, KEY, "left_semi"))
        staged = to_mart_types(customer_mart(
            customers.join(affected, KEY, "left_semi"), daily, until, as_of, window_days))
        mart.change(lambda current: upsert_mart(current, mart.spread(staged), as_of), affected, check=mart_gate,
                    tags={stream: batch_id, seen_until: until.toordinal()}, tries=TRIES)

    return (telemetry.writeStream.foreachBatch(absorb)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
