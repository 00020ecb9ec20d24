from __future__ import annotations

import re
from collections import Counter, defaultdict

import regex

from tests.llm.cases import by_id, corpus, documents, empty
from usagemart.llm import quality_rules

WORD, LETTERS = re.compile(r"[^\x20\x09-\x0D]+"), regex.compile(r"[^\p{L}]+")


def normal(line):
    return LETTERS.sub(" ", line.lower()).strip(" ") or line.strip(" \t\n\x0b\x0c\r")


def expected(rows, limit):
    hosts = defaultdict(set)
    for row in rows:
        for line in (row.text or "").split("\n"):
            hosts[row.source or "", normal(line)].add(row.text)
    found = {}
    for row in rows:
        text = row.text or ""
        words = WORD.findall(text)
        runs = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        repeated = {j for i in range(len(words) - 4) if runs[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        chars = sum(map(len, words))
        taken = sum(len("".join(WORD.findall(line))) for line in text.split("\n")
                    if normal(line) and len(hosts[row.source or "", normal(line)]) > limit)
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        found[row.doc_id] = (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                             len(repeated), taken, failed, not failed and not chars - taken < 0.2 * chars)
    return found


def test_counts_lines_and_verdict(spark):
    rows = corpus(spark).persist()
    got = quality_rules.judged(rows, limit=3).collect()
    assert len(got) == rows.count()
    assert {i: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_taken_chars,
                r.base_failed, r.kept) for i, r in by_id(got).items()} == expected(rows.collect(), 3)


def test_depleted_documents_are_rejected_and_lines_removed(spark):
    menu = "Home About Contact Imprint Privacy Terms of use and more"
    own = ["this document number {0} has enough words of its own to stay {0}".format(c * 5) for c in "abcdefgh"]
    rows = documents(spark, [f"{menu}\n{text}" for text in own] + [f"{menu}\n{c}" for c in "rstuvw"])
    rows = rows.selectExpr("doc_id", "text", "'host' AS source")
    verdict = by_id(quality_rules.judged(rows, limit=5).collect())
    assert [verdict[10_000_000 + i].kept for i in range(14)] == [True] * 8 + [False] * 6
    texts = {r.doc_id: r.text for r in quality_rules.cleaned(rows, limit=5).collect()}
    assert texts == {10_000_000 + i: text for i, text in enumerate(own)}


def test_lines_without_letters_count(spark):
    own = ["this document {0} has enough words of its own to stay {0}".format(c * 5) for c in "abcdefgh"]
    rows = documents(spark, [f"{text}\n--- 12 ---" for text in own]).selectExpr("doc_id", "text", "'host' AS source")
    assert {r.n_taken_chars for r in quality_rules.judged(rows, limit=5).collect()} == {8}
    assert {r.text for r in quality_rules.cleaned(rows, limit=5).collect()} == {*own}


def test_copies_count_once_towards_a_line(spark):
    rows = documents(spark, ["the very same text of ten words or more in all copies"] * 9).selectExpr(
        "doc_id", "text", "'host' AS source")
    assert all(r.kept for r in quality_rules.judged(rows, limit=5).collect())


def test_empty_table(spark):
    assert quality_rules.judged(empty(spark)).collect() == []


def test_main_path_stays_in_the_jvm(spark):
    plan = quality_rules.judged(corpus(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
