from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as driver
from tests.compare import spark_rows, sql_rows
from tests.llm.cases import SCHEMA, corpus, empty
from usagemart.llm import collocations

BREAK, WORD = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[^ \t]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def expected(rows, support, top):
    counts, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang = "und" if row.lang is None else row.lang
        for piece in BREAK.split((row.text or "").translate(LOWER)):
            words = WORD.findall(piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        frequent = {p: n for p, n in f.items() if n >= support and len(p) > 1}
        explained = Counter()
        for p, n in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    explained[p[i:i + k]] = max(explained[p[i:i + k]], n)
        kept = []
        for p, a in frequent.items():
            if explained[p] < a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        found += [(lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
                  for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(found)


@pytest.mark.parametrize("sample", [1, 3, 10_000])
def test_equals_counting_everything(spark, sample):
    rows = corpus(spark).persist()
    got = sorted(map(tuple, collocations.best(rows, support=6, top=300, sample=sample).collect()))
    assert got == expected(rows.collect(), 6, 300)


def test_ties_overlaps_and_hot_languages(spark):
    dice = random.Random(3)
    rows = [(i, " ".join(dice.choice(["a", "B", "b,", "c", "d.", "É", "\t", "e\re"]) for _ in range(60)),
             dice.choice([None, "und", "en", "en", "en"]), None, None) for i in range(60)]
    rows += [(900 + i, "x x x x x x x x", "fr", None, None) for i in range(9)] + [(1, "a a", "de", None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, collocations.best(frame, support=9, top=40, sample=4).collect()))
    assert got == expected(frame.collect(), 9, 40) and {r[0] for r in got} == {"und", "en", "fr"}


def test_border_failures_open_further_passes(spark):
    frame = spark.createDataFrame([(i, "one two three four five six " * 2, "en", None, None) for i in range(20)], SCHEMA)
    rows = collocations.hashed(frame)
    keys, passes = collocations.frequent_keys(rows, 20, sample=2)
    # Nothing is sampled at all: words come first, and one more pass adds all that is built of them.
    alone, more = collocations.frequent_keys(rows, 20, sample=1 << 40)
    assert passes == 1 and more == 2
    assert sorted(keys.collect()) == sorted(alone.distinct().collect()) and alone.count() == keys.count()


def test_a_full_bitmap_counts_more_and_answers_the_same(spark, monkeypatch):
    rows = corpus(spark).persist()
    want = collocations.best(rows, support=6, top=100).collect()
    monkeypatch.setattr(collocations, "LEAST_BITS", 6)
    monkeypatch.setattr(collocations, "HELD", 1_000)
    monkeypatch.setattr(collocations, "bitmap", lambda keys, f=collocations.bitmap: f(keys, 6))
    assert sorted(collocations.best(rows, support=6, top=100).collect()) == sorted(want)


def test_scores_beyond_64_bits(spark):
    big = 4 * 10 ** 13
    counts = spark.createDataFrame([("en", "", 9 * 10 ** 17), ("en", "a b", big), ("en", "a", 2 * big), ("en", "b", big)],
                                   "lang string, phrase string, n bigint")
    row, = collocations.scored(counts).collect()
    assert row.score == 1000 * big * 9 * 10 ** 17 // (2 * big * big) and (row.a, row.l, row.r) == (big, 2 * big, big)


def test_empty_table(spark):
    assert collocations.best(empty(spark)).collect() == []


def test_same_answer_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_rows(driver.queries()["op13_collocations"](spark, folder)) == sql_rows(
        folder, driver.oracle_sql()["op13_collocations"])
