"""From raw documents to token ids: five stages, each over all that the one before it kept.

A document is a row; repeated rows are copies of each other. Null columns, other columns and an empty
table are handled as the operators' docstrings say. Stages return the columns of their input, the last
one (doc_id, n_tokens, ids, ids_sha256, decoded_sha256) with ids as little-endian 32-bit integers.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from usagemart.llm import byte_pairs, near_duplicates, secret_scan, toxicity
from usagemart.llm.decontaminate import contamination
from usagemart.llm.queries import VOCABULARY
from usagemart.llm.rows import stored, table

# The scores, the samples and the byte pairs have no SQL form; tests hold every stage against
# versions without Spark.
ORACLE_SQL = None


def _without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``bad`` (doc_id, text_key) does not name, with the columns of ``docs``."""
    bad = bad.select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    key = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]) & (key == bad["_bad_key"]), "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the lexicon, learnt from the labelled ones among them, calls toxic go."""
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    scored = toxicity.score(docs, model)
    return _without(docs, stored(scored.where(F.col("score") >= toxicity.DECIDE_AT), "toxic"))


def one_of_each_class(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near duplicates stays, the one of least id."""
    return near_duplicates.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the benchmark contaminates go; all others stay as they are."""
    found = contamination(docs, table(spark, folder, "benchmark"))
    return _without(docs, stored(found.where("contaminated").select("doc_id", "text_key"), "contaminated"))


def without_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Secrets are masked within the texts; every document stays. ``n_chars`` stays that of the source."""
    return secret_scan.redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids of all texts, with the digests of the ids and of what they decode to."""
    ranks = byte_pairs.read_ranks(public_tokenizers.path(VOCABULARY))
    encoded = byte_pairs.encode(docs, ranks, public_tokenizers.PATTERN)
    return byte_pairs.decode(encoded, ranks).select(
        "doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("MinHash near-dedup", one_of_each_class),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{i}")
    return docs
