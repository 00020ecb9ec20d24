"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from usagemart.sources import files

# Spark's own size checks decide on broadcasts, and AQE splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "usagemart", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session for the jobs of this package. On a cluster, leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_threads = threading.local()


def _open_scopes() -> list[list[str]]:
    """The folders made in each of the scopes that this thread has open."""
    if not hasattr(_threads, "scopes"):
        _threads.scopes = []
    return _threads.scopes


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Scratch folders that are made within this block are removed at its end, also after a failure.

    Yields a function that writes a frame to a folder that stays (or belongs to the scope around), for what the block
    returns: a lazy frame must not read a folder that is gone.
    """
    made: list[str] = []
    scopes = _open_scopes()
    scopes.append(made)

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        made.remove(path)
        if len(scopes) > 1:
            scopes[-2].append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield keep
    finally:
        scopes.pop()
        for path in made:
            files.remove(spark, path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names. Every executor must see it, so a machine-local one serves only a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="usagemart-")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _open_scopes():
        _open_scopes()[-1].append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Several jobs can use it without computing it again, it survives lost executors, and its size
    is known, so Spark can decide on a broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
