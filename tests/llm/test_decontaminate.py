from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from tests.llm.cases import SF, by_id, clashing, corpus, documents, empty
from usagemart.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return tuple(WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)})))


def expected(rows, items):
    windows = defaultdict(set)
    for item in items:
        w = words(item.text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows[w[i:i + k]].add("" if item.item_id is None else str(item.item_id))
    found = {}
    for row in rows:
        w, hit, held = words(row.text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if w[i:i + k] in windows:
                    hit.update(range(i, i + k))
                    held |= windows[w[i:i + k]]
        found[row.doc_id] = (len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(),
                             bool(hit) and 20 * len(hit) >= len(w))
    return found


def check(spark, rows, items):
    got = decontaminate.contamination(rows, items).collect()
    assert len(got) == rows.count()
    got = {i: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for i, r in by_id(got).items()}
    assert got == expected(rows.collect(), items.collect())
    return got


def test_equals_brute_force(spark):
    given_items = spark.read.parquet(f"{SF}/benchmark.parquet")
    odd = [(900, "the of"), (901, ""), (902, None), (903, "and the"), (None, "Word WORD word"), (900, "text without an id"),
           (904, "a b c d e f a b c d e f a b")]
    items = given_items.unionByName(spark.createDataFrame(odd, given_items.schema))
    got = check(spark, corpus(spark).persist(), clashing(items))
    assert sum(r[4] for r in got.values()) > 5


def test_every_shared_span_is_found_wherever_it_stands(spark):
    dice = random.Random(3)
    fresh = lambda n: [f"w{dice.randrange(10 ** 6)}" for _ in range(n)]
    items = [fresh(60) for _ in range(5)] + [["a"] * 40]
    texts = []
    for n in (12, 13, 14, 25, 60):
        for item in items:
            at = dice.randrange(len(item) - min(n, len(item)) + 1)
            texts.append(" ".join(fresh(dice.randrange(20)) + item[at:at + n] + fresh(dice.randrange(20))))
    benchmark = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id bigint, text string")
    check(spark, documents(spark, texts), benchmark)
    # The same without a broadcast.
    before, decontaminate.BROADCAST_ROWS = decontaminate.BROADCAST_ROWS, 0
    try:
        check(spark, documents(spark, texts), benchmark)
    finally:
        decontaminate.BROADCAST_ROWS = before


def kept(values):
    """Places that winnowing keeps, by its definition."""
    n = decontaminate.WINDOW
    return {min(range(i, i + n), key=lambda j: (values[j], j)) for i in range(len(values) - n + 1)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=9, max_size=30), st.lists(st.integers(0, 5), max_size=20),
       st.lists(st.integers(0, 5), max_size=20))
def test_the_guarantee(shared, before, after):
    """A run of as many k-grams as a window has is kept at the same place in both texts."""
    one, two = kept(shared), kept(before + shared + after)
    assert {p + len(before) for p in one} <= two


def test_empty_tables(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    check(spark, empty(spark), items)
    check(spark, documents(spark), items.limit(0))


def test_main_path_stays_in_the_jvm(spark):
    plan = decontaminate.contamination(corpus(spark), spark.read.parquet(f"{SF}/benchmark.parquet"))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
