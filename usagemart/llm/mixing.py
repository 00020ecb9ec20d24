"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

1. Sizes (words) are summed by source. Sources in order of their names get weights by turns; the total is shared
   by weight. A source whose share exceeds ``MAX_EPOCHS`` times its size is clamped there, and what it cannot
   take is shared among the others, round by round, until nobody is above. All that a round keeps is the
   share of one unit of weight, as a fraction: whoever is above it is clamped, and it only ever rises.
2. Of a source with ``goal`` words to give and ``source_size`` words to give them from, every document is taken
   ``goal div source_size`` times. The rest goes round once more in the seeded order of the documents: each is
   taken whole until the rest is used up, and the last one in part, so a source meets its goal to the word.
   The order is that of a hash, so bins of the hash are summed first; only the one bin of each source in which
   the rest runs out is sorted.

Sums are whole numbers and shares are compared as fractions, so equal inputs give equal mixes.

Defined cases: null text has no words; null source is a source of its own, the last; a source without words
has the target 0; rows that share id and text are interchangeable, and may be taken a different number
of times; an empty table gives no rows. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from usagemart.llm.rows import SPACE, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 11
_BIN_DIGITS = 3  # hexadecimal; 4,096 bins of a source


def sized(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, draw) of every row; ``draw`` places it in its source's order."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return documents.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(F.array_remove(F.split(text, SPACE), "")).cast("long").alias("size"), F.md5(named).alias("draw"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with their rank by name, null last: sorted in parts, each of which starts where others end."""
    ordered = stored(sources.orderBy(F.col("source").asc_nulls_last())
                     .withColumn("place", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("place", 33)  # as the function documents it
    starts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("least"))
    # A row for each part of the sort.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return ordered.withColumn("part", part).join(starts.select("part", "before", "least"), "part").select(
        "source", "source_size", (F.col("before") + F.col("place") - F.col("least")).alias("rank"))


def _whole(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(19,0)")


def water_level(capped: DataFrame, total: int) -> tuple[int, int]:
    """(rest, weight): what a unit of weight gets, as a fraction, once all sources above it are clamped.

    ``capped`` has (cap, weight) of every source. A round reads that table and returns two sums.
    """
    rest, weight = total, capped.agg(F.sum("weight")).first()[0] or 1
    while True:
        clamped = _whole("cap") * F.lit(weight).cast("decimal(18,0)") < F.lit(rest).cast("decimal(18,0)") * _whole("weight")
        taken, left = capped.agg(F.sum(F.when(clamped, _whole("cap"))),
                                 F.sum(F.when(~clamped, F.col("weight")))).first()
        now = total - int(taken or 0), int(left or 1)
        if now == (rest, weight):
            return now
        rest, weight = now


def targets(sized_rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, goal) of every source; ``goal`` is the target's whole part."""
    by_name = sized_rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    weighed = stored(ranked(by_name).select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long").alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap")), "weighed")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    rest, weight = water_level(weighed, total)
    share = F.lit(rest).cast("decimal(18,0)") * _whole("weight")
    clamped = _whole("cap") * F.lit(weight).cast("decimal(18,0)") < share
    return weighed.select(
        "source", "source_size",
        F.when(clamped, F.col("cap").cast("double")).otherwise(
            F.lit(rest).cast("double") * F.col("weight") / F.lit(weight).cast("double")).alias("target"),
        F.when(clamped, F.col("cap")).otherwise(
            F.call_function("div", share, F.lit(weight).cast("decimal(18,0)"))).cast("long").alias("goal"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row; ``taken``: words of it in the mix."""
    rows = stored(sized(documents, seed).withColumn("bin", F.substring("draw", 1, _BIN_DIGITS)), "sized")
    shares = stored(targets(rows, weights, max_epochs).withColumns({
        "times": F.when(F.col("source_size") > 0, F.expr("goal div source_size")).otherwise(F.lit(0)),
        "rest": F.when(F.col("source_size") > 0, F.expr("goal % source_size")).otherwise(F.lit(0))}), "shares")
    bins = rows.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    cut = bins.select(F.col("source").alias("_source"), F.col("bin").alias("cut"), "words", "before")
    cuts = stored(shares.join(cut, F.col("source").eqNullSafe(F.col("_source"))
                              & (F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")),
                              "left").drop("_source", "words").withColumnRenamed("source", "_source"), "cuts")
    placed = rows.join(cuts, rows["source"].eqNullSafe(cuts["_source"]))
    beyond = placed.where("cut IS NULL OR bin != cut").withColumn(
        "more", F.when(F.col("bin") < F.col("cut"), F.col("size")).otherwise(F.lit(0)))
    order = Window.partitionBy("source").orderBy("draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    there = placed.where("bin = cut").withColumn(
        "start", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn(
        "more", F.least("size", F.greatest(F.col("rest") - F.col("start"), F.lit(0)))).drop("start")
    return beyond.unionByName(there).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("times") * F.col("size") + F.col("more")).cast("long").alias("taken"), "draw")


def repeated(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: (doc_id, source, repetition, text), a row each time a document is taken, the last
    perhaps in part. Rows that share id and text are taken as often as all of them together."""
    taken = mix(documents, **options).groupBy("draw").agg(
        F.sum("taken").alias("taken"), F.first("size").alias("size")).where("taken > 0")
    seed = options.get("seed", SEED)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(
        "doc_id", F.col("source").cast("string").alias("source"), text.alias("text"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                       F.md5(text))).alias("draw")).dropDuplicates(["draw"])
    listed = F.array_remove(F.split("text", SPACE), "")
    part = F.least(F.col("size"), F.col("taken") - F.col("repetition") * F.col("size"))
    return rows.join(taken, "draw").withColumn(
        "repetition", F.explode(F.sequence(F.lit(0), F.expr("cast(ceil(taken / size) as int) - 1")))).select(
        "doc_id", "source", "repetition",
        F.when(part == F.col("size"), F.col("text")).otherwise(
            F.array_join(F.slice(listed, F.lit(1), part.cast("int")), " ")).alias("text"))
