"""Small tables with the cases that operators must stand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = [None, "", " \n\t \x0b\x0c\r", "a", "Ünïcode 😀 text\nmit Zeilen\r\n", "a b c d e f a b c d e f a b c d e",
       "#*$%&|<> # #", "x" * 5_000, "word " * 4_000, "0123456789" * 300]


def documents(spark: SparkSession, texts=None, first: int = 10_000_000) -> DataFrame:
    rows = [(first + i, text, "en", f"src{i % 2}" if i % 3 else None, None)
            for i, text in enumerate(ODD if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus(spark: SparkSession) -> DataFrame:
    """Given documents, odd ones, one without an id, repeated rows, and columns that could clash."""
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    nameless = spark.createDataFrame([(None, "text without an id", None, None, None)], SCHEMA)
    rows = given.unionByName(documents(spark)).unionByName(nameless)
    return clashing(rows.unionByName(rows.where("doc_id % 50 = 7")))


def clashing(rows: DataFrame) -> DataFrame:
    names = ["text_key", "words", "key", "hash", "start", "n_words", "spans", "root", "bucket", "_doc_id", "host"]
    return rows.withColumns({name: F.lit("x") for name in names})


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def by_id(rows) -> dict:
    """Rows by id; repeated ones must be equal."""
    found = {}
    for row in rows:
        assert found.setdefault(row.doc_id, row) == row
    return found
