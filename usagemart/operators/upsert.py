"""Changing the mart: keyed upsert, insert-if-absent, touch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window, functions as F

from usagemart.functions.temporal import date_literal, ts_literal
from usagemart.functions.text import aliased
from usagemart.schemas import MART_COLUMNS

KEY = "customer_id"

# Set once, when the customer first appears.
KEPT_ON_UPDATE = ("registration_date", "created_at")


def require_batch_key(batch: DataFrame, key: str = KEY) -> DataFrame:
    """``batch`` itself, failing while it runs if a key is missing or occurs twice.

    The window sorts by the key just as the following join does, so it adds no shuffle.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    verdict = f"""CASE
        WHEN {key} IS NULL THEN raise_error('{key} is NULL in the batch')
        WHEN _nth > 1 THEN raise_error(concat('{key} occurs twice in the batch: ', {key}))
        END"""
    return (batch.withColumn("_nth", nth)
            .where(f"coalesce(CAST({verdict} AS boolean), true)").drop("_nth"))


def upsert_mart(current: DataFrame, staged: DataFrame, as_of: datetime) -> DataFrame:
    """``current`` with ``staged`` rows inserted, or written over rows of the same key.

    An update takes every staged value, NULLs too, except the columns in ``KEPT_ON_UPDATE``.
    """
    def merged(name: str) -> str:
        if name == KEY:
            return f"coalesce(new.{KEY}, old.{KEY})"
        if name == "updated_at":
            return f"if(new.{KEY} IS NOT NULL, {ts_literal(as_of)}, old.updated_at)"
        first, second = ("old", "new") if name in KEPT_ON_UPDATE else ("new", "old")
        return f"if({first}.{KEY} IS NOT NULL, {first}.{name}, {second}.{name})"

    joined = current.alias("old").join(
        require_batch_key(staged).alias("new"), F.expr(f"old.{KEY} = new.{KEY}"), "full_outer")
    return joined.selectExpr(*aliased({name: merged(name) for name in MART_COLUMNS}))


def insert_ignore(current: DataFrame, new: DataFrame, key: str = KEY) -> DataFrame:
    """``current`` plus the rows of ``new`` whose key it does not hold yet.

    Of several new rows with one key a single one is taken, whichever comes first by its values.
    """
    others = sorted(c for c in current.columns if c != key)
    first = Window.partitionBy(key).orderBy(*others)
    # Each task keeps one row per key before the shuffle, and the anti join reuses the shuffle.
    single = (new.select(*current.columns)
              .withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth"))
    absent = single.join(current.select(key), key, "left_anti").select(*current.columns)
    return current.unionByName(absent)


def refresh_customers(mart: DataFrame, ids: Sequence[int] | DataFrame,
                      as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """Stamp the chosen customers as refreshed now.

    Returns the whole mart and, separately, the rows that changed. A few ids come as a list and
    become a filter that the scan can use; many come as a DataFrame, and Spark picks the join by
    its size.
    """
    stamp = {"load_date": date_literal(as_of.date()), "updated_at": ts_literal(as_of)}
    if isinstance(ids, DataFrame):
        wanted = ids.select(KEY).distinct().withColumn("_hit", F.lit(True))
        marked = mart.join(wanted, KEY, "left")
    else:
        marked = mart.withColumn("_hit", F.col(KEY).isin(list(ids)))
    whole = marked.selectExpr(*aliased({
        name: f"if(_hit, {stamp[name]}, {name})" if name in stamp else name
        for name in mart.columns}))
    changed = marked.where("_hit").selectExpr(KEY, "email", *aliased(stamp))
    return whole, changed
