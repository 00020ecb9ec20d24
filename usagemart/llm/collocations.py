"""Collocations by Toivonen's sampling: phrases whose words keep company more than chance has it.

1. A seeded sample of the documents is counted; phrases that reach a lowered threshold there are proposed.
2. A full pass counts the proposed phrases and their negative border: all phrases whose beginning and end, of
   one word less, are proposed, and all single words. Whatever is frequent and not counted yet lies beyond a frequent
   phrase of the border. If there are any, an expansion pass counts what they add to the border, and what that
   may add in turn, after which nothing frequent is left outside the proposal.
3. A last pass counts the frequent phrases once more, by hashes of twice the length, and notes one place of each,
   from where its words are read.

Words are hashed once, and phrases are hashes too, counted within tasks before they are shuffled. What tasks know of
the proposal is a bitmap of bounded size: a phrase that it holds by chance is counted for nothing, and hashes that
meet add up, so both can only bring in more than is wanted, and the last pass decides.

Scores are whole numbers: ``1000 a n`` may pass 64 bits and is a decimal of 38 digits.

Defined cases: null text is empty; null lang is ``und``; a language without frequent phrases has no rows; repeated
rows are counted each; an empty table gives no rows. Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from usagemart.llm.rows import small, stored

LONGEST, SUPPORT, TOP = 5, 100, 2_000
SAMPLE = 8  # one document in so many
LOWERED = 0.6  # of the support that the sample would show on average
UNKNOWN = "und"
LEAST_BITS, MOST_BITS = 16, 26
HELD = 1_000_000  # phrases whose counts a task holds before it adds them up or passes them on
_BREAK = "\n"  # no word holds one
_MIX = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


# -- phrases of a task ---------------------------------------------------------------------------

def tokens(text: Column | str) -> Column:
    """Words in lower case (A to Z only), and a line feed between pieces."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(F.regexp_replace(lowered, r"[.,;:!?\x0A-\x0D]+", " \n "), r"[\x20\x09]+"), "")


def _hashes(listed: Column) -> Column:
    """0 stands for the break between pieces."""
    return F.transform(listed, lambda word: F.when(word == _BREAK, F.lit(0).cast("long")).otherwise(F.xxhash64(word)))


def _rows(documents: DataFrame) -> DataFrame:
    """(row, lang, text); ``row`` names a document by all that counts of it."""
    rows = documents.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    return rows.select(F.xxhash64("doc_id", "lang", "text").alias("row"), "lang", "text")


def hashed(documents: DataFrame) -> DataFrame:
    """(row, lang, seed, n_words, words) of every document, stored: its words as hashes, read by every pass."""
    listed = _rows(documents).withColumn("tokens", tokens("text"))
    return stored(listed.select("row", "lang", F.xxhash64("lang").alias("seed"),
                                F.size(F.array_remove("tokens", _BREAK)).cast("long").alias("n_words"),
                                _hashes(F.col("tokens")).alias("words")), "words")


def _mixed(x: np.ndarray, odd: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * odd
    return x ^ (x >> np.uint64(29))


def phrases(langs: np.ndarray, words: pa.ListArray, longest: int, odd: np.uint64 = _MIX) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length, (keys by place, whether a phrase starts there); places are those of ``words.flatten()``.

    The three lowest bits of a key are the phrase's length, the others a hash of its language and words.
    """
    sizes = np.diff(words.offsets.to_numpy())
    flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    found, hashed, there = [], np.repeat(langs.astype(np.int64).view(np.uint64), sizes), np.ones(len(flat), bool)
    for n in range(1, longest + 1):
        ahead = np.arange(len(flat)) + (n - 1)
        inside = ahead < len(flat)
        ahead = np.minimum(ahead, max(len(flat) - 1, 0))
        there = there & inside & (row[ahead] == row) & (flat[ahead] != 0) if len(flat) else there
        hashed = _mixed(hashed * _MIX + flat[ahead] + _MIX, odd)
        found.append((hashed >> np.uint64(3) << np.uint64(3) | np.uint64(n), there))
    return found


class Bitmap:
    """A set of keys, of bounded size; it may hold more than was put in, never less."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.shift, self.cells = np.uint64(64 - bits), cells

    def holds(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> self.shift
        return (self.cells[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def bitmap(keys: DataFrame, most_bits: int = MOST_BITS) -> Bitmap:
    """The (stored) keys as a bitmap of 16 bits a key, within bounds."""
    bits = int(np.clip(np.ceil(np.log2(max(keys.count(), 1))) + 4, LEAST_BITS, most_bits))
    place = F.shiftrightunsigned("key", 64 - bits)
    cells = np.zeros(1 << bits - 6, "<u8")
    found = keys.select(F.shiftright(place, 6).alias("cell"), F.expr(f"1L << cast(shiftrightunsigned(key, {64 - bits}) & 63 AS INT)").alias("bit"))
    table = found.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2 ** (bits - 6) rows
    cells[table["cell"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return Bitmap(bits, cells.view(np.uint8))


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    merged, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return merged, np.bincount(inverse, np.concatenate(counts), len(merged)).astype(np.int64)


def _counted(rows: DataFrame, longest: int, held: Bitmap | None = None, before: Bitmap | None = None) -> DataFrame:
    """(key, n) of single words and of the phrases whose beginning and end ``held`` holds (all, if None). With ``before``:
    only of phrases that a pass with that bitmap did not count, and a beginning or end counted here will do as well."""
    context = rows.sparkSession.sparkContext
    held, before = (bitmap and context.broadcast(bitmap) for bitmap in (held, before))  # of bounded size

    def wanted(piece: pa.RecordBatch) -> Iterator[np.ndarray]:
        found = phrases(piece.column("seed").to_numpy(zero_copy_only=False), piece.column("words"), longest)
        counted = None
        for n, (keys, there) in enumerate(found, 1):
            if n > 1 and held is not None:
                known = held.value.holds(found[n - 2][0])
                if before is not None and counted is not None:
                    known |= counted
                there = there & known & np.append(known[1:], False)
            if before is not None:
                known = before.value.holds(found[n - 2][0]) if n > 1 else there
                counted = there = there & ~(known & np.append(known[1:], n == 1))
                if n == 1:
                    counted = there = np.zeros(len(keys), bool)  # all words are counted in the first pass
            yield keys[there]

    def batch(keys, counts):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

    def task(batches):
        keys, counts, waiting, total = [], [], 0, 0
        for piece in small(batches):
            for found in wanted(piece):
                once, n = np.unique(found, return_counts=True)
                keys.append(once)
                counts.append(n)
                waiting += len(once)
            if waiting > HELD:
                merged, summed = _added(keys, counts)
                if len(merged) > HELD // 2:
                    yield batch(merged, summed)
                    keys, counts = [], []
                else:
                    keys, counts = [merged], [summed]
                waiting = len(keys[0]) if keys else 0
        if keys:
            yield batch(*_added(keys, counts))

    return rows.select("seed", "words").mapInArrow(task, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


# -- passes --------------------------------------------------------------------------------------

def _proposed(rows: DataFrame, support: int, sample: int) -> DataFrame:
    """Keys of the phrases of fewer than ``LONGEST`` words that a sample of the documents lets expect."""
    chosen = rows.where(F.pmod("row", F.lit(sample)) == 0)
    least = max(1, int(LOWERED * support / sample))
    return stored(_counted(chosen, LONGEST - 1).where(F.col("n") >= least).select("key"), "proposed")


def frequent_keys(rows: DataFrame, support: int = SUPPORT, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """(key) of every frequent phrase, and the number of full passes that it took.

    An expansion counts whatever can be frequent, given what is: a phrase whose beginning and end are each known to be,
    or counted by the same pass. So one expansion closes the search.
    """
    proposed = _proposed(rows, support, sample)
    first = bitmap(proposed)
    found = stored(_counted(rows, LONGEST, first).where(F.col("n") >= support).select("key"), "frequent")
    beyond = stored(found.where(F.col("key").bitwiseAND(F.lit(7)) < LONGEST).join(proposed, "key", "left_anti"), "beyond")
    if beyond.isEmpty():
        return found, 1
    more = _counted(rows, LONGEST, bitmap(proposed.unionByName(beyond)), first)
    return found.unionByName(stored(more.where(F.col("n") >= support).select("key"), "expanded")), 2


def _placed(rows: DataFrame, held: Bitmap) -> DataFrame:
    """(key, other, n, row, at) of the phrases that ``held`` holds: exact counts by both hashes, and one place of each."""
    shared = rows.sparkSession.sparkContext.broadcast(held)  # of bounded size
    names = ["key", "other", "n", "row", "at"]

    def task(batches):
        ready, waiting = [], 0
        for piece in small(batches):
            words = piece.column("words")
            seeds, ids = (piece.column(name).to_numpy(zero_copy_only=False) for name in ("seed", "row"))
            offsets = words.offsets.to_numpy()
            row = np.repeat(np.arange(len(piece)), np.diff(offsets))
            for (keys, there), (others, _) in zip(phrases(seeds, words, LONGEST), phrases(seeds, words, LONGEST, _OTHER)):
                at = np.flatnonzero(there)
                at = at[shared.value.holds(keys[at])]
                order = np.argsort(keys[at], kind="stable")
                at = at[order]
                key, other = keys[at], others[at]
                new = np.r_[True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])][:len(at)]
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                at = at[first]
                ready.append([key[first].view(np.int64), other[first].view(np.int64), n, ids[row[at]],
                              at - (offsets[row[at]] - offsets[0])])
                waiting += len(first)
            if waiting > HELD // 4:
                yield merged(ready)
                ready, waiting = [], 0
        if ready:
            yield merged(ready)

    def merged(ready):
        """Rows of one key and other hash as one, with the place of any."""
        columns = [np.concatenate(column) for column in zip(*ready)]
        order = np.lexsort(columns[1::-1])
        columns = [column[order] for column in columns]
        new = np.ones(len(order), bool)
        new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        first = np.flatnonzero(new)
        n = np.add.reduceat(columns[2], first) if len(first) else columns[2]
        return pa.RecordBatch.from_arrays(
            [pa.array(n if name == "n" else column[first], pa.int64()) for name, column in zip(names, columns)], names)

    places = rows.select("row", "seed", "words").mapInArrow(task, ", ".join(f"{name} bigint" for name in names))
    return places.groupBy("key", "other").agg(F.sum("n").alias("n"), F.min_by("at", "row").alias("at"),
                                              F.min("row").alias("row"))


def _worded(documents: DataFrame, places: DataFrame) -> DataFrame:
    """(lang, phrase, n) of ``places``, with their words read from where they are."""
    asked = stored(places.groupBy("row").agg(F.collect_list(F.struct(
        F.col("at"), F.col("key").bitwiseAND(F.lit(7)).alias("size"), "n")).alias("asked")), "asked")
    rows = _rows(documents)
    context = rows.sparkSession.sparkContext
    held = context.broadcast(bitmap(asked.select(F.xxhash64("row").alias("key"))))  # of bounded size

    def there(batches):
        for piece in small(batches):
            mask = held.value.holds(piece.column("name").to_numpy(zero_copy_only=False).view(np.uint64))
            yield piece.filter(pa.array(mask)).select(["row", "lang", "text"])

    # Few documents hold the first places of all phrases; only those are shuffled.
    named = rows.withColumn("name", F.xxhash64("row")).mapInArrow(there, "row bigint, lang string, text string")
    found = named.dropDuplicates(["row"]).join(asked, "row").select("lang", tokens("text").alias("tokens"), "asked")

    def task(batches):
        for piece in small(batches, 100):
            langs, texts, counts = [], [], []
            for lang, words, asked in zip(*(piece.column(name).to_pylist() for name in ("lang", "tokens", "asked"))):
                for place in asked:
                    langs.append(lang)
                    texts.append(" ".join(words[place["at"]:place["at"] + place["size"]]))
                    counts.append(place["n"])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts, pa.string()),
                                              pa.array(counts, pa.int64())], ["lang", "phrase", "n"])

    return found.mapInArrow(task, "lang string, phrase string, n bigint")


def frequent(documents: DataFrame, support: int = SUPPORT, sample: int = SAMPLE) -> DataFrame:
    """(lang, phrase, n) of every phrase of up to ``LONGEST`` words found ``support`` times or more in its language, and
    of the empty phrase: all words of the language. Stored."""
    rows = hashed(documents)
    keys, _ = frequent_keys(rows, support, sample)
    places = stored(_placed(rows, bitmap(stored(keys, "keys"))).where(F.col("n") >= support), "places")
    totals = rows.groupBy("lang").agg(F.lit("").alias("phrase"), F.sum("n_words").alias("n"))
    return stored(_worded(documents, places).unionByName(totals), "counts")


# -- scores --------------------------------------------------------------------------------------

def _part(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of phrases of two words or more, by the cut that scores least, without those that
    a longer phrase explains as often."""
    size = F.size("words")
    all_words = counts.where("phrase = ''").select("lang", F.col("n").alias("all"))
    parts = counts.where("phrase != ''").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias("_n"))
    longer = counts.withColumn("words", F.split("phrase", " ")).where(size >= 2)

    def count_of(frame: DataFrame, part: str, name: str) -> DataFrame:
        side = parts.withColumnsRenamed({"_n": name})
        return frame.join(side, (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_part"))).drop(
            "_lang", "_part", part)

    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", F.col("n").alias("a"), "cut", _part(F.lit(1), F.col("cut")).alias("left"),
        _part(F.col("cut") + 1, size - F.col("cut")).alias("right"))
    cuts = count_of(count_of(cuts, "left", "l"), "right", "r").join(all_words, "lang")
    wide = lambda name, digits: F.col(name).cast(f"decimal({digits},0)")
    over = (F.lit(1000).cast("decimal(4,0)") * wide("a", 14)) * wide("all", 18)
    cuts = cuts.withColumn("score", F.call_function("div", over, wide("l", 18) * wide("r", 18)).cast("long"))
    least = cuts.groupBy("lang", "phrase", "a", "all").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    # Counts never grow with a phrase, so some phrase that holds it is as frequent only if one of a word more is.
    within = longer.where(size >= 3).select(
        F.col("lang").alias("_lang"), "n",
        F.explode(F.array(_part(F.lit(1), size - 1), _part(F.lit(2), size - 1))).alias("_phrase"))
    within = within.groupBy("_lang", "_phrase").agg(F.max("n").alias("most"))
    return least.join(within, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left").where(
        "most IS NULL OR 100 * most < 100 * a").select(
        "lang", "phrase", "a", F.col("least.l").alias("l"), F.col("least.r").alias("r"), F.col("all").alias("n"),
        F.col("least.score").alias("score"))


def best(documents: DataFrame, support: int = SUPPORT, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` by score, count and phrase."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(frequent(documents, support, sample)).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
