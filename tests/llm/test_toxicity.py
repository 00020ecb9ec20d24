from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import SF, clashing, corpus, documents, empty
from usagemart.llm import toxicity

LABELS = "doc_id bigint, toxic int"


def labelled(spark):
    """Prose in which a few words, stems and an excused phrase tell toxic texts."""
    dice = random.Random(2)
    plain = [f"word{dice.randrange(10 ** 6)}" for _ in range(300)]
    texts, toxic = [], []
    for i in range(600):
        words = dice.choices(plain, k=40)
        bad = i % 4 == 0
        if bad:
            words[dice.randrange(1, 39)] = dice.choice(["meanie", f"gloob{dice.randrange(99)}a"])
        elif i % 25 == 1:
            words[10:12] = ["meanie", "bar"]
        texts.append(" ".join(words))
        toxic.append(int(bad))
    rows = documents(spark, texts)
    return rows, spark.createDataFrame([(10_000_000 + i, t) for i, t in enumerate(toxic)], LABELS)


@pytest.fixture(scope="module")
def learnt(spark):
    return toxicity.learn(*labelled(spark))


def test_learns_words_stems_and_excuses(spark, learnt):
    assert any("meanie".startswith(term.strip()) for term in learnt.terms)
    assert any(term.strip() and "gloob".startswith(term.strip()[:5]) for term in learnt.terms)
    assert " meanie bar " in learnt.excuses


def test_held_out_accuracy(spark, learnt):
    rows, labels = labelled(spark)
    got = toxicity.predicted(toxicity.score(rows, learnt)).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.predicted == r.toxic for r in got) >= 0.98 * len(got)


@pytest.mark.parametrize("text, toxic", [
    ("you are a meanie today", 1), ("you are a m3anie today", 1), ("you are a mеаnie today", 1),  # Cyrillic letters
    ("you are a ｍｅａｎｉｅ today", 1), ("you saw the meanie bar today", 0), ("nothing to see here", 0), ("", 0), (None, 0)])
def test_folding_and_excuses(spark, learnt, text, toxic):
    row = toxicity.predicted(toxicity.score(documents(spark, [text]), learnt)).first()
    assert row.predicted == toxic and 0 <= row.score <= 1


def test_longer_texts_score_lower_for_the_same_word(spark, learnt):
    rows = documents(spark, ["meanie " + "calm " * n for n in (3, 300, 3000)])
    scores = [r.score for r in toxicity.score(rows, learnt).orderBy("doc_id").collect()]
    assert scores[0] > scores[1] > scores[2]


def test_held_out_rows_and_other_columns_do_not_matter(spark, learnt):
    rows, labels = labelled(spark)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.learn(clashing(rows), clashing(flipped))
    assert again == learnt


def test_tables_without_rows_or_labels(spark):
    rows, labels = corpus(spark), spark.read.parquet(f"{SF}/labels.parquet")
    none = spark.createDataFrame([], LABELS)
    for docs, known in ((rows, none), (empty(spark), labels), (empty(spark), none)):
        model = toxicity.learn(docs, known)
        assert model.terms == {} and toxicity.score(docs, model).count() == docs.count()
    contradicting = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None)], LABELS)
    assert toxicity.score(rows, toxicity.learn(rows, contradicting)).count() == rows.count()
