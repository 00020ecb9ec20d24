"""The registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from usagemart.llm import (
    byte_pairs, collocations, conversations, language_model, licences, mixing, near_duplicates, personal_data, quality_rules, repeats,
    secret_scan, toxicity)
from usagemart.llm.decontaminate import contamination
from usagemart.llm.rows import table
from usagemart.llm.sql import SQL  # noqa: F401

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_pairs.read_ranks(public_tokenizers.path(VOCABULARY))
    encoded = byte_pairs.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_pairs.digests(byte_pairs.decode(encoded, ranks))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents")).drop("text_key")


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.classes(table(spark, folder, "documents")).select("doc_id", "class_id", "first")


def op4_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digest(repeats.without_repeats(table(spark, folder, "documents")))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity.learn(documents, table(spark, folder, "labels"))
    return toxicity.predicted(toxicity.score(documents, model))


def op6_licences(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return licences.by_document(documents, licences.learn(documents))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scores(table(spark, folder, "documents"))


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return personal_data.digest(personal_data.find(documents, personal_data.learn(documents)))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digest(secret_scan.secrets(table(spark, folder, "documents")))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_key")


def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source", "draw")


def op12_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.digest(table(spark, folder, "conversations"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.best(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_pairs": op1_byte_pairs,
    "op2_quality_rules": op2_quality_rules,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_repeats": op4_repeats,
    "op5_toxicity": op5_toxicity,
    "op6_licences": op6_licences,
    "op7_language_model": op7_language_model,
    "op8_personal_data": op8_personal_data,
    "op9_secrets": op9_secrets,
    "op10_decontaminate": op10_decontaminate,
    "op11_mixing": op11_mixing,
    "op12_conversations": op12_conversations,
    "op13_collocations": op13_collocations,
}
