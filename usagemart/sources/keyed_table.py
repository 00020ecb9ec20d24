"""A keyed Parquet table that can be changed while others read it.

Plain Parquet has no MERGE, and a job must not overwrite the files it reads. So rows live in
``data/attempt=<a>/bucket=<b>`` by a hash of the key. A change writes the buckets it touches into the folder
of its own attempt, and a commit makes them visible together: a small file, named by its number, that
says for every bucket which attempt holds it. Numbers are consecutive and a file is never overwritten, so
of two writers who started from the same commit the second one fails and may run again (``tries``); neither can
lose the other's rows. What an attempt that died has written is in no commit and stays unseen.

A change works from one commit throughout: it names the buckets of its keys, reads them, and publishes against that
commit. Rows that it stages for other buckets than those it names fail it.

Reading costs the same after any number of commits: a hint names a recent one, and from there the
following numbers are tried.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from usagemart.sources import files


class ConcurrentChange(RuntimeError):
    """Another writer committed first. Nothing was published; the change may be made again."""


@dataclass(frozen=True)
class Commit:
    """The state of a table: the attempt of every bucket, and the last number of every tag."""

    number: int = 0
    attempts: tuple[str | None, ...] = ()
    tags: Mapping[str, int] = field(default_factory=dict)

    def to_json(self) -> str:
        known = sorted({a for a in self.attempts if a is not None})
        at = {name: i for i, name in enumerate(known)}
        return json.dumps({"number": self.number, "known": known, "tags": dict(self.tags),
                           "attempts": [None if a is None else at[a] for a in self.attempts]})

    @staticmethod
    def from_json(text: str) -> Commit:
        row = json.loads(text)
        return Commit(row["number"], tuple(
            None if a is None else row["known"][a] for a in row["attempts"]), row["tags"])


class KeyedTable:
    """``looked_up`` names columns by which a few rows may be looked for in the whole table: their files get
    Bloom filters, so that a reader with a short list skips almost all of them. A ``summary`` turns the rows of
    some buckets, which also have a column ``bucket``, into a few rows for each bucket. They are written and
    committed with the bucket, in a folder of their own for each name."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str,
                 buckets: int = 64, summary: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
                 looked_up: Iterable[str] = ()):
        self.looked_up = tuple(looked_up)
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.wanted, self.summarize = buckets, dict(summary or {})

    # -- commits ---------------------------------------------------------------------------

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def latest(self) -> Commit:
        hint = f"{self.root}/commits/hint"
        number = int(files.read_text(self.spark, hint)) if files.exists(self.spark, hint) else 0
        while files.exists(self.spark, self._commit_path(number + 1)):
            number += 1
        if not number:
            return Commit()
        return Commit.from_json(files.read_text(self.spark, self._commit_path(number)))

    def _publish(self, base: Commit, attempts: Iterable[str | None],
                 tags: Mapping[str, int] | None) -> Commit:
        commit = Commit(base.number + 1, tuple(attempts), {**base.tags, **(tags or {})})
        if not files.write_text(self.spark, self._commit_path(commit.number), commit.to_json()):
            raise ConcurrentChange(f"{self.root}: somebody else wrote commit {commit.number}")
        files.write_text(self.spark, f"{self.root}/commits/hint", str(commit.number), replace=True)
        return commit

    def committed(self, tag: str, number: int) -> bool:
        """Whether a change with this tag and number, or a later one of the tag, is published."""
        return self.latest().tags.get(tag, -1) >= number

    @property
    def buckets(self) -> int:
        """Buckets of the current content; of an empty table, as many as wanted."""
        return len(self.latest().attempts) or self.wanted

    # -- reading ---------------------------------------------------------------------------

    def _select(self, chosen: Mapping[int, str | None], kind: str, schema: T.StructType) -> DataFrame:
        by_attempt: dict[str, list[int]] = {}
        for bucket, attempt in sorted(chosen.items()):
            if attempt is not None:
                by_attempt.setdefault(attempt, []).append(bucket)
        if not by_attempt:
            return self.spark.createDataFrame([], schema)
        layout = T.StructType(list(schema.fields)).add("attempt", "string").add("bucket", "integer")
        # Both are partition columns: Spark opens only the chosen folders.
        wanted = reduce(lambda a, b: a | b, [
            (F.col("attempt") == attempt) & F.col("bucket").isin(members)
            for attempt, members in by_attempt.items()])
        folders = [f"{self.root}/{kind}/attempt={attempt}" for attempt in by_attempt]
        data = (self.spark.read.schema(layout).option("basePath", f"{self.root}/{kind}")
                .parquet(*folders))
        return data.where(wanted).select(*schema.fieldNames())

    def read(self, buckets: Iterable[int] | None = None, at: Commit | None = None) -> DataFrame:
        """The rows of a commit (by default the current one), or those of some of its buckets."""
        live = dict(enumerate((at or self.latest()).attempts))
        if buckets is not None:
            live = {b: live.get(b) for b in buckets}
        return self._select(live, "data", self.schema)

    def summaries(self, name: str, at: Commit | None = None) -> DataFrame:
        """The rows of a summary for all buckets, as they were committed with the rows of a commit."""
        live = dict(enumerate((at or self.latest()).attempts))
        return self._select(live, name, self._summary_schema(name))

    def has_summary(self, name: str, at: Commit | None = None) -> bool:
        """Whether all buckets have it: those written before a table got a summary do not."""
        return all(files.exists(self.spark, f"{self.root}/{name}/attempt={attempt}")
                   for attempt in {*(at or self.latest()).attempts} - {None})

    def _summary_schema(self, name: str) -> T.StructType:
        layout = T.StructType(list(self.schema.fields)).add("bucket", "integer")
        found = self.summarize[name](self.spark.createDataFrame([], layout)).schema
        return T.StructType([T.StructField(f.name, f.dataType) for f in found if f.name != "bucket"])

    def expired(self) -> DataFrame:
        """Folders (attempt, bucket) of earlier commits that the newest one does not use, for the
        retention job of the storage. Reads all commits, as it runs rarely."""
        live = [(a, b) for b, a in enumerate(self.latest().attempts) if a is not None]
        kind = "number BIGINT, known ARRAY<STRING>, attempts ARRAY<INT>"
        seen = (self.spark.read.schema(kind).json(f"{self.root}/commits/*.json")
                .select("known", F.posexplode("attempts").alias("bucket", "at")).where("at IS NOT NULL")
                .select(F.expr("known[at]").alias("attempt"), "bucket").distinct())
        return seen.join(self.spark.createDataFrame(live, "attempt STRING, bucket INT"),
                         ["attempt", "bucket"], "left_anti")

    # -- writing ---------------------------------------------------------------------------

    def bucket(self, buckets: int | None = None) -> Column:
        """The hash that Spark's own shuffle uses, so a shuffle partition is one bucket."""
        return F.pmod(F.hash(F.col(self.key)), F.lit(buckets or self.buckets))

    def buckets_of(self, rows: DataFrame, at: Commit | None = None) -> list[int]:
        """Buckets of a commit (by default the current one) that hold the keys of ``rows``: at most ``buckets`` numbers."""
        count = len((at or self.latest()).attempts) or self.wanted
        return sorted(r[0] for r in rows.select(self.bucket(count).alias("bucket")).distinct().collect())

    def spread(self, rows: DataFrame, buckets: int | None = None) -> DataFrame:
        """One shuffle partition per bucket; joins and aggregates on the key reuse it."""
        return rows.repartition(buckets or self.buckets, self.key)

    def _stage(self, rows: DataFrame, buckets: int) -> str:
        """Write ``rows``, spread by key, into a new attempt's folder, which nobody sees yet."""
        attempt = uuid.uuid4().hex
        path = f"{self.root}/data/attempt={attempt}"
        (rows.to(self.schema).withColumn("bucket", self.bucket(buckets))
         .sortWithinPartitions("bucket", self.key)
         .write.options(**{f"parquet.bloom.filter.enabled#{c}": "true" for c in self.looked_up})
         .partitionBy("bucket").parquet(path))
        layout = T.StructType(list(self.schema.fields)).add("bucket", "integer")
        for name, summarize in self.summarize.items():
            (summarize(self.spark.read.schema(layout).parquet(path)).repartition(1)
             .write.partitionBy("bucket").parquet(f"{self.root}/{name}/attempt={attempt}"))
        return attempt

    def ensure(self) -> None:
        """Create the table, empty, unless it is there."""
        if not self.latest().number:
            self.replace(self.spark.createDataFrame([], self.schema))

    def replace(self, rows: DataFrame, tags: Mapping[str, int] | None = None) -> None:
        """Make ``rows`` the whole content, in the number of buckets that this table was opened with."""
        base = self.latest()
        attempt = self._stage(self.spread(rows, self.wanted), self.wanted)
        self._publish(base, [attempt] * self.wanted, tags)

    def change(self, transform: Callable[[DataFrame], DataFrame],
               touched: list[int] | DataFrame | None = None,
               check: Callable[[DataFrame, DataFrame | None], None] | None = None,
               tags: Mapping[str, int] | None = None, tries: int = 1) -> tuple[Commit, list[int]]:
        """Rewrite the content, or only the ``touched`` buckets, through ``transform``; returns the commit that holds the
        result, and the buckets that were written.

        ``touched`` may be a frame with the keys that will change: their buckets are named anew on each try.
        ``check`` gets the whole resulting table and, if only some buckets were written, their
        rows. It may raise, which leaves the change unpublished. With nothing touched, only tags are
        published, if there are any. If somebody else commits in between, all is done again from their commit,
        ``tries`` times in total.
        """
        while True:
            try:
                return self._change(transform, touched, check, tags)
            except ConcurrentChange:
                tries -= 1
                if tries < 1:
                    raise

    def _change(self, transform, touched, check, tags) -> tuple[Commit, list[int]]:
        base = self.latest()
        live = list(base.attempts) or [None] * self.wanted
        if isinstance(touched, DataFrame):
            touched = self.buckets_of(touched, base)
        if touched is not None and not touched and not tags:
            return base, []
        members = list(range(len(live))) if touched is None else touched
        if members:
            current = self._select({b: live[b] if b < len(live) else None for b in members}, "data", self.schema)
            attempt = self._stage(transform(self.spread(current, len(live))), len(live))
            written = {int(name.partition("=")[2]) for name in files.names(self.spark, f"{self.root}/data/attempt={attempt}")
                       if name.startswith("bucket=") and name[7:].isdigit()}
            if not written <= set(members) <= set(range(len(live))):
                raise ValueError(f"{self.root}: the change wrote buckets {sorted(written)[:5]}, but named {members[:5]} "
                                 f"of {len(live)}")
            fresh = dict.fromkeys(members, attempt)
            if check is not None:
                check(self._select({**dict(enumerate(live)), **fresh}, "data", self.schema),
                      None if len(members) == len(live) else self._select(fresh, "data", self.schema))
            for bucket in members:
                live[bucket] = attempt
        return self._publish(base, live, tags), members
