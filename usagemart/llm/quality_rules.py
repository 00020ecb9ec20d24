"""Quality rules: counts within a text, and lines that too many documents of a host share.

Lines are normalised (lower case; runs of anything but letters become one blank) and hashed. A hash that
more than ``LINE_DOCUMENTS`` distinct texts of one host (``source``) hold is above the limit; such lines
are taken out, and a document that keeps less than ``KEPT_SHARE`` of its word characters is depleted.
DataFrame operations only.

Defined cases: null or empty text has no words and fails; a null source is a host of its own; copies
of a text count once towards a line, and a line once in each text; every row, repeated or not, is judged;
lines without letters are never above the limit. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from usagemart.llm.decontaminate import with_grams
from usagemart.llm.rows import SPACE_CHARS, by_row, stored, texts, words

SYMBOLS = "#*$%&|<>"
RUN = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
LINE_DOCUMENTS, KEPT_SHARE = 100, 0.2


def without(text: str | Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words() -> Column:
    """Words inside runs of five that occur twice or more, from the column ``grams`` of their hashes."""
    placed = F.sort_array(F.transform("grams", lambda gram, i: F.struct(gram.alias("gram"), i.alias("at"))))
    # Neighbours in the order of the hashes; the places of equal ones, in order, cover the words.
    same = F.aggregate(
        placed,
        F.struct(F.lit(None).cast("struct<gram:bigint,at:int>").alias("last"), F.lit(False).alias("met"),
                 F.array().cast("array<int>").alias("at")),
        lambda a, x: F.struct(
            x.alias("last"), F.coalesce(a["last"]["gram"] == x["gram"], F.lit(False)).alias("met"),
            F.when(a["last"]["gram"] == x["gram"], F.concat(
                a["at"], F.when(a["met"], F.array(x["at"])).otherwise(F.array(a["last"]["at"], x["at"]))))
            .otherwise(a["at"]).alias("at")),
        lambda a: a["at"])
    covered = F.aggregate(
        F.sort_array(same), F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda a, at: F.struct((at + RUN).alias("end"),
                               (a["total"] + at + RUN - F.greatest(a["end"], at)).alias("total")),
        lambda a: a["total"])
    return F.when(F.size(F.array_distinct("grams")) < F.size("grams"), covered).otherwise(F.lit(0))


def _hosted(documents: DataFrame) -> DataFrame:
    """(doc_id, text, host, text_key); the key is of the text and its host."""
    host = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host")
    return texts(documents, host).withColumn("text_key", F.xxhash64("text", "host"))


def counts(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    lines = F.filter(F.split("text", "\n"), lambda line: without(line, SPACE_CHARS) != "")
    rows = _hosted(documents).select(
        "doc_id", "text_key", words("text").alias("words"), lines.alias("lines"),
        F.length(without("text", SPACE_CHARS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without("text", SYMBOLS))).cast("long").alias("n_symbols"))
    rows = with_grams(rows, RUN)
    return rows.select(
        "doc_id", "text_key", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words().cast("long").alias("n_repeat_words"))


def line_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, host, at, line, chars): each line with a word, ``line`` being the hash of its letters, or of
    itself if it has none (numbers, rules of dashes)."""
    def normal(line: Column) -> Column:
        letters = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))
        return F.when(letters != "", letters).otherwise(F.trim(line, F.lit(SPACE_CHARS)))

    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(normal(line).alias("normal"), line.alias("line")))
    return (_hosted(documents).select("doc_id", "text_key", "host", F.posexplode(lines).alias("at", "l"))
            .where("l.normal != ''")
            .select("doc_id", "text_key", "host", "at", F.xxhash64("l.normal").alias("line"),
                    F.length(without("l.line", SPACE_CHARS)).alias("chars")))


def frequent_lines(documents: DataFrame, limit: int = LINE_DOCUMENTS) -> DataFrame:
    """(host, line, documents) of lines above the limit.

    The first shuffle is by host, line and text, so that no line gathers; then one count for each task
    and line is shuffled.
    """
    return (line_rows(documents).select("host", "line", "text_key").distinct()
            .groupBy("host", "line").agg(F.count("*").alias("documents")).where(F.col("documents") > limit))


def judged(documents: DataFrame, limit: int = LINE_DOCUMENTS, share: float = KEPT_SHARE) -> DataFrame:
    """One row for each document row: its counts, the characters taken out, and the verdicts."""
    above = stored(frequent_lines(documents, limit).select("host", "line"), "lines")
    taken = (line_rows(documents).join(above, ["host", "line"])
             .select("doc_id", "text_key", "at", "chars").distinct()  # repeated rows: the same lines
             .groupBy("doc_id", "text_key").agg(F.sum("chars").alias("taken")))
    taken_chars = F.coalesce("taken", F.lit(0)).cast("long")
    rows = by_row(counts(documents), taken).withColumn("n_taken_chars", taken_chars).drop("taken")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    depleted = F.col("word_chars") - F.col("n_taken_chars") < share * F.col("word_chars")
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def cleaned(documents: DataFrame, limit: int = LINE_DOCUMENTS) -> DataFrame:
    """(doc_id, text) of the kept rows, without the lines above their host's limit."""
    above = stored(frequent_lines(documents, limit).select("host", "line"), "lines")
    cut = line_rows(documents).join(above, ["host", "line"]).groupBy("doc_id", "text_key").agg(
        F.collect_set("at").alias("cut"))  # at most the lines of one text
    kept = judged(documents, limit).where("kept").select("doc_id", "text_key").distinct()
    rows = by_row(by_row(_hosted(documents), kept, "left_semi"), cut)
    left = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("cut", i))
    return rows.select("doc_id", F.when(F.col("cut").isNull(), F.col("text"))
                       .otherwise(F.array_join(left, "\n")).alias("text"))
