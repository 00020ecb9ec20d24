"""Benchmark decontamination by winnowing, with DataFrame operations only.

Every ``window`` consecutive k-grams keep their leftmost smallest hash. Two texts that share
``window + k - 1`` words in a row share such a run of k-grams, hence a kept fingerprint at the same
place of it: no shared span of that length is missed. Documents and benchmark items meet on equal
fingerprints; each meeting is extended by comparing the words around it.

Defined cases: null or empty text has no words; an item of fewer words than the span is searched
whole; items without words never occur; items may repeat or share an id (an id counts once); a null
``item_id`` counts as the id ``''``; repeated document rows each get the same result; an empty table
on either side gives no hits. Only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from usagemart.llm.rows import by_row, row_key, stored, texts

GRAM, WINDOW = 5, 9
SPAN = GRAM + WINDOW - 1
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A benchmark of up to so many fingerprints (24 bytes and 21 words each) goes to every executor.
BROADCAST_ROWS = 50_000


def item_words(text: str | Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lowered, GAP), "")


def with_words(rows: DataFrame) -> DataFrame:
    return rows.withColumn("words", item_words("text")).withColumn("n_words", F.size("words"))


def with_grams(rows: DataFrame, k: int) -> DataFrame:
    """Adds ``grams``: hashes of all runs of ``k`` words, in order; null for a row of fewer words.

    Rows are not filtered by their words, and arrays are exploded as outer ones with the nulls
    dropped afterwards: Spark would push the filter, which an explode also implies, below all of
    these columns, and compute them again in it for every place they are named.
    """
    hashes = F.col("hashes")
    grams = F.transform(
        F.slice(hashes, F.lit(1), F.size(hashes) - (k - 1)),
        lambda first, i: F.xxhash64(first, *(F.get(hashes, i + j) for j in range(1, k))))
    return (rows.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
            .withColumn("grams", F.when(F.size(hashes) >= k, grams)).drop("hashes"))


def least_grams(rows: DataFrame) -> DataFrame:
    """Adds ``least``: the smallest hash of every window of k-grams; null for a shorter row.

    Single elements are read by index: ``slice`` within a lambda copies the whole array each time.
    """
    grams = F.col("grams")
    least = F.transform(
        F.slice(grams, F.lit(1), F.size(grams) - (WINDOW - 1)),
        lambda first, i: F.least(first, *(F.get(grams, i + j) for j in range(1, WINDOW))))
    return with_grams(rows, GRAM).withColumn("least", F.when(F.size(grams) >= WINDOW, least))


def kept_grams(rows: DataFrame) -> DataFrame:
    """Adds ``kept``: the distinct (hash, place) pairs that winnowing keeps, places ascending."""
    grams, places = F.col("grams"), F.col("places")
    placed = least_grams(rows).withColumn("places", F.transform("least", lambda value, i: F.coalesce(
        *(F.when(F.get(grams, i + j) == value, i + j) for j in range(WINDOW)))))
    pairs = F.arrays_zip(F.col("least").alias("hash"), places.alias("place"))
    return placed.withColumn("kept", F.filter(pairs, lambda _, i: (
        (i == 0) | (F.get(places, i) != F.get(places, i - 1))))).drop("grams", "least", "places")


def around(place: str) -> Column:
    """The words that a span over the k-gram at ``place`` may hold, and before them as many."""
    first = F.greatest(F.col(place) - (WINDOW - 1), F.lit(0))
    return F.slice("words", first + 1, F.col(place) + SPAN - first)


def fingerprints(rows: DataFrame, place: str, near: str, count: str, *keys: str) -> DataFrame:
    """A row for each kept fingerprint: its hash, place, the words around it, the row's length."""
    return (kept_grams(rows).select(*keys, "n_words", "words", F.explode_outer("kept").alias("at"))
            .select(*keys, F.col("n_words").alias(count), "words", F.col("at.hash").alias("hash"),
                    F.col("at.place").alias(place))
            .where("hash IS NOT NULL").withColumn(near, around(place)).drop("words"))


def _sized(benchmark: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(benchmark) if rows <= BROADCAST_ROWS else benchmark


def _long_hits(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, text_key, item, start, length) of all spans that documents share with long items."""
    prints = stored(fingerprints(items, "q", "item_near", "item_count", "item"), "benchmark")
    n = prints.count()
    met = (least_grams(documents)
           .select("doc_id", "text_key", F.explode_outer(F.array_distinct("least")).alias("hash"))
           .join(_sized(prints.select("hash").distinct(), n), "hash", "left_semi")
           .select("doc_id", "text_key").distinct())
    # Few documents meet the benchmark; what Spark knows of the stored keys' size picks the join.
    found = fingerprints(by_row(documents, stored(met, "met"), "left_semi"), "p", "doc_near", "doc_count",
                         "doc_id", "text_key").distinct()
    pairs = found.join(_sized(prints, n), "hash")
    reach = WINDOW - 1
    first_p = F.greatest(F.col("p") - reach, F.lit(0))
    first_q = F.greatest(F.col("q") - reach, F.lit(0))
    starts = F.filter(F.sequence(first_p, F.col("p")), lambda s: (
        (F.col("q") - F.col("p") + s >= 0)
        & (s + SPAN <= F.col("doc_count")) & (F.col("q") - F.col("p") + s + SPAN <= F.col("item_count"))
        & (F.slice("doc_near", s - first_p + 1, SPAN)
           == F.slice("item_near", F.col("q") - F.col("p") + s - first_q + 1, SPAN))))
    return (pairs.select("doc_id", "text_key", "item", F.explode_outer(starts).alias("start"))
            .where("start IS NOT NULL").withColumn("length", F.lit(SPAN)))


def _short_hits(documents: DataFrame, items: DataFrame, length: int) -> DataFrame:
    """The same for items of ``length`` words: all runs of that length meet the whole items."""
    wanted = (with_grams(items.where(F.col("n_words") == length), length)
              .select("item", F.col("words").alias("whole"), F.col("grams")[0].alias("hash")))
    wanted = stored(wanted, "short")
    runs = (with_grams(documents, length)
            .select("doc_id", "text_key", "words", F.posexplode_outer("grams").alias("start", "hash"))
            .withColumn("run", F.slice("words", F.col("start") + 1, length)).drop("words"))
    same = runs.join(_sized(wanted, wanted.count()), "hash").where("run = whole")
    return same.select("doc_id", "text_key", "item", "start", F.lit(length).alias("length"))


def shared_spans(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All places of documents that hold a window of an item: (doc_id, text_key, item, start, length)."""
    docs = with_words(texts(documents).withColumn("text_key", row_key())).drop("text")
    items = stored(with_words(benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))).drop("text"), "items")
    lengths = [row[0] for row in items.where(F.col("n_words").between(1, SPAN - 1))
               .select("n_words").distinct().collect()]  # at most SPAN - 1 numbers
    hits = _long_hits(docs, items)
    for length in sorted(lengths):
        hits = hits.unionByName(_short_hits(docs, items, length))
    return hits


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row: word counts, items found, and the verdict.

    ``contaminated``: some word is hit and the hit words are a twentieth of all or more.
    """
    hits = shared_spans(documents, benchmark)
    joined = (hits.groupBy("doc_id", "text_key")
              .agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
                   F.sort_array(F.collect_set("item")).alias("items")))
    union = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["length"]).alias("end"),
            (a["total"] + F.greatest(s["start"] + s["length"] - F.greatest(a["end"], s["start"]),
                                     F.lit(0))).alias("total")),
        lambda a: a["total"])
    joined = joined.select("doc_id", "text_key", union.alias("hit"), "items")
    counted = texts(documents).select(
        "doc_id", row_key(), F.size(item_words("text")).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (by_row(counted, joined)
            .select("doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"), "text_key")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))
