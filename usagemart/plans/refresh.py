"""Refresh on demand for chosen customers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from time import monotonic

from pyspark.sql import DataFrame, functions as F

from usagemart.operators.mart import customer_mart, to_mart_types
from usagemart.operators.upsert import KEY, refresh_customers, upsert_mart
from usagemart.plans.home import TRIES, Home, mart_gate
from usagemart.session import materialize, scratch_scope
from usagemart.sources.audit import append_audit, audit_row

PROCESS = "manual_report_generation"


def refresh_on_demand(home: Home, ids: Sequence[int] | DataFrame, as_of: datetime,
                      customers: DataFrame | None = None,
                      telemetry: DataFrame | None = None) -> DataFrame:
    """Stamp the chosen customers as refreshed and log it; returns their rows.

    Given the sources, their metrics are computed again first. Only the buckets that hold the
    chosen customers are read and written.
    """
    with scratch_scope(home.spark) as keep:
        refreshed = _refreshed(home, ids, as_of, customers, telemetry)
        return keep(refreshed, "refreshed") if isinstance(ids, DataFrame) else refreshed


def _refreshed(home: Home, ids: Sequence[int] | DataFrame, as_of: datetime, customers: DataFrame | None,
               telemetry: DataFrame | None) -> DataFrame:
    started, table = monotonic(), home.mart
    recompute = customers is not None and telemetry is not None
    if isinstance(ids, DataFrame):
        chosen = keys = materialize(ids.select(KEY).distinct(), "refresh-ids")
    else:
        # A list stays one, so that all scans can use it as a filter.
        chosen = [int(i) for i in ids]
        listed = F.explode(F.lit(chosen).cast("array<bigint>")).alias(KEY)
        keys = home.spark.range(0, 1, 1, numPartitions=1).select(listed)

    def only(rows: DataFrame) -> DataFrame:
        if isinstance(chosen, list):
            return rows.where(F.col(KEY).isin(chosen))
        return rows.join(chosen, KEY, "left_semi")

    def transform(current: DataFrame) -> DataFrame:
        if recompute:
            known = only(current.select(KEY))
            staged = customer_mart(only(customers).join(known, KEY, "left_semi"), only(telemetry),
                                   as_of.date(), as_of)
            current = upsert_mart(current, table.spread(to_mart_types(staged)), as_of)
        return refresh_customers(current, chosen, as_of)[0]

    # A mere stamp changes no key, so there is nothing to check.
    commit, buckets = table.change(transform, keys, check=mart_gate if recompute else None, tries=TRIES)
    refreshed = only(table.read(buckets, commit)).select(KEY, "email", "load_date", "updated_at")
    end = as_of + timedelta(seconds=monotonic() - started)
    append_audit(audit_row(home.spark, PROCESS, as_of.date(), as_of, end, refreshed.count(),
                           "success"), home.audit)
    return refreshed
