from __future__ import annotations

import re
from collections import defaultdict
from fractions import Fraction

import pytest

import __spark_entry__ as driver
from tests.compare import spark_rows, sql_rows
from tests.llm.cases import SCHEMA, clashing, corpus, empty
from usagemart.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled(sizes, weights, epochs):
    """Targets as fractions, by clamping and sharing again."""
    total, clamped = sum(sizes), {}
    while True:
        rest = total - sum(clamped.values())
        left = [i for i in range(len(sizes)) if i not in clamped]
        weight = sum(weights[i] for i in left)
        share = {i: Fraction(rest * weights[i], weight) for i in left}
        above = [i for i in left if share[i] > epochs * sizes[i]]
        if not above:
            return [Fraction(clamped[i]) if i in clamped else share[i] for i in range(len(sizes))]
        clamped |= {i: epochs * sizes[i] for i in above}


def check(rows, documents, epochs=3, weights=(5, 2, 1)):
    sizes = defaultdict(int)
    for row in documents:
        sizes[row.source] += len(WORD.findall(row.text or ""))
    names = sorted(sizes, key=lambda name: (name is None, name or ""))
    targets = dict(zip(names, filled([sizes[n] for n in names], [weights[i % len(weights)] for i in range(len(names))],
                                     epochs)))
    taken = defaultdict(int)
    assert len(rows) == len(documents)
    for row in rows:
        assert row.source_size == sizes[row.source] and row.target == pytest.approx(float(targets[row.source]))
        assert 0 <= row.taken <= epochs * row.size
        taken[row.source] += row.taken
    assert {name: taken[name] for name in names} == {name: int(targets[name]) for name in names}


def test_targets_are_met_to_the_word(spark):
    rows = corpus(spark).persist()
    got = mixing.mix(rows).collect()
    check(got, rows.collect())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(rows.repartition(5)).collect()))


def test_clamping_goes_on_round_by_round(spark):
    # Shares of 'a', then of 'd' with what 'a' leaves, then of 'g': each is above only once the one before is clamped.
    sizes = {"a": 1, "b": 4000, "c": 9000, "d": 900, "e": 3000, "f": 2, "g": 1500, None: 70}
    rows = spark.createDataFrame(
        [(i, "w " * (size // 2 + half * (size % 2)), None, name, None)
         for i, (name, size) in enumerate(sizes.items()) for half in (0, 1)], SCHEMA)
    check(mixing.mix(clashing(rows)).collect(), rows.collect())
    check(mixing.mix(rows, weights=(1,), max_epochs=1).collect(), rows.collect(), 1, (1,))


def test_repetitions_are_the_words_taken(spark):
    rows = corpus(spark).dropDuplicates(["doc_id", "text"]).persist()
    taken = {(r.doc_id, r.source): r.taken for r in mixing.mix(rows).collect()}
    words, texts = defaultdict(int), {(r.doc_id, r.source): r.text or "" for r in rows.collect()}
    for row in mixing.repeated(rows).collect():
        assert WORD.findall(texts[row.doc_id, row.source])[:len(WORD.findall(row.text))] == WORD.findall(row.text)
        words[row.doc_id, row.source] += len(WORD.findall(row.text))
    assert words == {key: n for key, n in taken.items() if n}


def test_ties_repeats_and_words_nowhere(spark):
    rows = spark.createDataFrame([(1, "a b c", None, "x", None)] * 7 + [(2, None, None, "y", None)]
                                 + [(None, "q r", None, None, None)] * 2, SCHEMA)
    check(mixing.mix(rows).collect(), rows.collect())
    nothing = spark.createDataFrame([(1, "", None, "x", None), (2, None, None, None, None)], SCHEMA)
    assert {(r.size, r.target, r.taken) for r in mixing.mix(nothing).collect()} == {(0, 0.0, 0)}
    assert mixing.mix(empty(spark)).collect() == []


def test_same_answer_as_sql(spark):
    folder = "/root/testdata/sf0.01"
    assert spark_rows(driver.queries()["op11_mixing"](spark, folder)) == sql_rows(folder, driver.oracle_sql()["op11_mixing"])
