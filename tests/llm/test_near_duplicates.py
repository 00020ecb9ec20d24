from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, by_id, corpus, documents, empty
from usagemart.llm import near_duplicates
from usagemart.llm.components import components


def shingle_sets(rows):
    found = {}
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", (row.text or "").lower())
        found[row.doc_id] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return found


def test_every_near_pair_is_in_one_class(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    classes = {r.doc_id: r.class_id for r in near_duplicates.classes(rows).collect()}
    sets = shingle_sets(rows.collect())
    holders = defaultdict(set)
    for doc_id, found in sets.items():
        for shingle in found:
            holders[shingle].add(doc_id)
    common = defaultdict(int)
    for found in holders.values():
        for a, b in combinations(sorted(found), 2):
            common[a, b] += 1
    share = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in common.items()}
    near = [p for p, s in share.items() if s >= 0.8]
    assert len(near) > 80 and all(classes[a] == classes[b] for a, b in near)
    # Nothing is linked that is far apart: each member is near some other one of its class.
    groups = defaultdict(list)
    for doc_id, root in classes.items():
        groups[root].append(doc_id)
    for members in groups.values():
        for a in members if len(members) > 1 else []:
            assert max(share.get((min(a, b), max(a, b)), 0) for b in members if b != a) > 0.7


def edited(words, dice, n):
    words = list(words)
    for _ in range(n):
        words[dice.randrange(len(words))] = f"new{dice.randrange(10 ** 9)}"
    return " ".join(words)


def test_a_large_family_of_copies_is_one_class(spark):
    dice = random.Random(4)
    base = [f"w{dice.randrange(500)}" for _ in range(400)]
    other = " ".join(f"v{dice.randrange(10 ** 6)}" for _ in range(400))
    texts = [" ".join(base)] * 30 + [edited(base, dice, 3) for _ in range(120)] + [other]
    got = by_id(near_duplicates.classes(documents(spark, texts)).collect())
    assert {got[10_000_000 + i].class_id for i in range(150)} == {10_000_000}
    assert got[10_000_150].class_id == 10_000_150 and sum(r.first for r in got.values()) == 2


def test_defined_cases(spark):
    rows = corpus(spark)
    got = near_duplicates.classes(rows).collect()
    assert len(got) == rows.count()
    found = by_id(got)
    for i in range(3):  # null, empty, blanks
        assert found[10_000_000 + i].class_id == 10_000_000 + i and found[10_000_000 + i].first
    assert found[None].class_id is None
    kept = near_duplicates.one_of_each(rows)
    assert kept.columns == rows.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(set(ids)) == len(ids) and set(ids) == {r.doc_id for r in got if r.first}
    assert near_duplicates.classes(empty(spark)).collect() == []


def test_samples_agree_as_often_as_texts_are_similar():
    dice = np.random.default_rng(1)
    shared, n = dice.integers(1 << 62, size=700, dtype=np.uint64), 1000
    sides = [np.sort(np.r_[shared, dice.integers(1 << 62, size=n - 700, dtype=np.uint64)]) for _ in range(2)]
    weights = [1 + (side % np.uint64(3)).astype(np.float64) for side in sides]
    agreed = []
    for seed in range(40):
        near_duplicates.SEED += 1
        tables = near_duplicates._tables(3.0)
        one, two = (near_duplicates.samples(np.zeros(n, np.int64), side, weight, tables, 3.0)[0]
                    for side, weight in zip(sides, weights))
        agreed.append((one == two).mean())
    near_duplicates.SEED -= 40
    known = dict(zip(sides[0].tolist(), weights[0].tolist()))
    both = sum(w for v, w in zip(sides[1].tolist(), weights[1].tolist()) if v in known)
    true = both / (weights[0].sum() + weights[1].sum() - both)
    assert abs(np.mean(agreed) - true) < 0.05


@pytest.mark.parametrize("few", [0, 200_000])
@pytest.mark.parametrize("links", [[(1, 2), (2, 3), (4, 5)], [(i, i + 1) for i in range(60)],
                                   [(0, i) for i in range(1, 50)] + [(7, 7)]])
def test_components(spark, monkeypatch, links, few):
    monkeypatch.setattr("usagemart.llm.components.FEW_LINKS", few)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    roots = {}
    for a, b in links:
        roots.setdefault(a, a), roots.setdefault(b, b)
    for _ in roots:
        for a, b in links:
            roots[a] = roots[b] = min(roots[a], roots[b])
    assert got == {n: r for n, r in roots.items() if any(n in p and p[0] != p[1] for p in links)}


def test_repeated_rows_leave_one(spark):
    rows = spark.createDataFrame([(1, "one two three four five six", None, None, None)] * 3, SCHEMA)
    assert near_duplicates.one_of_each(rows).count() == 1


def test_a_bucket_is_searched_until_no_pair_is_left(spark):
    """Many pairs of near copies in one bucket, and members near nobody that lead first."""
    dice = random.Random(6)
    pairs = []
    for _ in range(9):
        base = [f"p{dice.randrange(10 ** 6)}" for _ in range(200)]
        pairs.append((" ".join(base), edited(base, dice, 1)))
    lone = [" ".join(f"q{dice.randrange(10 ** 6)}" for _ in range(200)) for _ in range(4)]
    rows = documents(spark, [*(text for pair in pairs for text in pair), *lone])
    weights = np.ones(1 << near_duplicates.IDF_BITS, np.float32)
    band = near_duplicates._bands()[0].tolist()
    # All meet in the first band; the other samples are their own.
    met = F.transform("samples", lambda x, i: F.when(i.isin(band), F.lit(7)).otherwise(x).cast("bigint"))
    distinct = near_duplicates.signed(rows, weights).select("key", met.alias("samples"))
    found = near_duplicates.links(rows, distinct, weights)
    roots = {bytes(r.node): bytes(r.root) for r in found.collect()}
    keys = {r.text: bytes(r.key) for r in rows.select("text", near_duplicates.text_key().alias("key")).collect()}
    assert len(roots) == 18 and len({*roots.values()}) == 9
    assert all(roots[keys[a]] == roots[keys[b]] for a, b in pairs)


def test_texts_with_a_common_passage_do_not_all_meet(spark, monkeypatch):
    """Work grows with the texts, not with their square, and what is alike among them is found."""
    dice = random.Random(8)
    passage = [f"c{i}" for i in range(120)]
    alike = [passage + [f"a{i}_{j}" for j in range(80)] for i in range(10)]
    rows = [" ".join(words) for words in alike] + [edited(words, dice, 1) for words in alike]
    rows += [" ".join(passage + [f"u{i}_{j}" for j in range(80)]) for i in range(600)]
    compared = []
    compare = near_duplicates.similarities

    def counted(pairs, known):
        compared.append(pairs.count())
        return compare(pairs, known)

    monkeypatch.setattr(near_duplicates, "similarities", counted)
    got = by_id(near_duplicates.classes(documents(spark, rows)).collect())
    assert all(got[10_000_010 + i].class_id == 10_000_000 + i for i in range(10))
    assert sum(r.first for r in got.values()) == 610
    assert sum(compared) < 620 * 619 / 8


def weighted_links(rows):
    """Pairs of weighted Jaccard similarity of the threshold or more, without samples or buckets."""
    sets = shingle_sets(rows)
    counts = defaultdict(int)
    for found in sets.values():
        for shingle in found:
            counts[shingle] += 1
    times = {}
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", (row.text or "").lower())
        tally = defaultdict(int)
        for i in range(max(1, len(words) - 4) if words else 0):
            tally[tuple(words[i:i + 5])] += 1
        times[row.doc_id] = {s: n * (1 + np.log10(min(len(rows) / counts[s], near_duplicates.RAREST)))
                             for s, n in tally.items()}
    holders = defaultdict(list)
    for doc_id, found in times.items():
        for shingle in found:
            holders[shingle].append(doc_id)
    pairs = {p for ids in holders.values() for p in combinations(sorted(ids), 2)}
    found = []
    for a, b in pairs:
        both = sum(min(w, times[b][s]) for s, w in times[a].items() if s in times[b])
        if both / (sum(times[a].values()) + sum(times[b].values()) - both) >= near_duplicates.THRESHOLD + 0.005:
            found.append((a, b))
    return found


def test_every_pair_of_weighted_similarity_is_in_one_class(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    classes = {r.doc_id: r.class_id for r in near_duplicates.classes(rows).collect()}
    found = weighted_links(rows.collect())
    assert len(found) > 80 and all(classes[a] == classes[b] for a, b in found)


def test_splits_keep_pairs_at_the_threshold_together():
    """Independent samples; what is stated next to the parameters."""
    agreed = np.random.default_rng(5).random((20_000, near_duplicates.SAMPLES)) < near_duplicates.THRESHOLD
    together = np.stack([agreed[:, band].all(axis=1) for band in near_duplicates._bands()], axis=1)
    for split, parted in zip(near_duplicates._levels(), (0.008, 0.022, 0.048, 0.085)):
        ways = agreed[:, split].all(axis=3)
        together = (together[:, :, None] & ways).reshape(len(agreed), -1)
        assert 1 - together.any(axis=1).mean() < parted


def test_few_pairs_at_the_threshold_meet_in_no_bucket():
    """With independent samples, no more than eight bands of three samples of their own would miss."""
    agreed = np.random.default_rng(5).random((200_000, near_duplicates.SAMPLES)) < near_duplicates.THRESHOLD
    met = np.zeros(len(agreed), bool)
    for band in near_duplicates._bands():
        met |= agreed[:, band].all(axis=1)
    assert 1 - met.mean() <= (1 - 0.8 ** 3) ** 8


def test_sketches_rule_out_edited_copies_and_no_near_pair(spark):
    """Copies of one text, each edited in places of its own: what sketches leave holds all pairs at the threshold, and few others."""
    dice = np.random.default_rng(7)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(60):
        copy = list(base)
        for at in dice.choice(60, i % 4, replace=False):
            copy[at] = f"e{i}x{at}"
        texts.append(" ".join(copy))
    rows = documents(spark, texts).selectExpr("CAST(doc_id AS string) AS k", "text").selectExpr("CAST(k AS binary) AS key", "text")
    weights = np.ones(1 << near_duplicates.IDF_BITS, np.float32)
    known = near_duplicates.weighted(rows.select("key", near_duplicates._hashes().alias("words")), weights).persist()
    sketches = near_duplicates.sketched(known)
    one, two = (known.selectExpr(f"key AS {name}") for name in "ab")
    pairs = one.join(two, F.expr("a < b")).persist()
    sides = pairs.join(sketches.selectExpr("key AS a", "sketch", "total AS total_a"), "a").join(
        sketches.selectExpr("key AS b", "sketch AS leader_sketch", "total AS total_b"), "b")
    left = {(bytes(r.a), bytes(r.b)) for r in sides.selectExpr("a", "b", "sketch", "leader_sketch", "total_a + total_b AS total")
            .mapInArrow(near_duplicates._near_by_sketch, "a binary, b binary").collect()}
    found = {(bytes(r.a), bytes(r.b)): r.similarity for r in near_duplicates.similarities(pairs, known).collect()}
    near = {pair for pair, similarity in found.items() if similarity >= near_duplicates.THRESHOLD}
    assert near and near <= left
    assert len(left - near) < 0.25 * len(found.keys() - near)


def test_few_pairs_of_edited_copies_are_compared(spark, monkeypatch):
    """Copies of one text just below the threshold from each other: hardly more pairs are compared than are near."""
    dice = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = documents(spark, [edited(base, dice, i % 5) for i in range(400)])
    compared, near = [], []
    compare = near_duplicates.similarities

    def counted(pairs, known):
        compared.append(pairs.count())
        found = compare(pairs, known).persist()
        near.append(found.where(F.col("similarity") >= near_duplicates.THRESHOLD).count())
        return found

    monkeypatch.setattr(near_duplicates, "similarities", counted)
    near_duplicates.classes(rows).count()
    assert sum(near) > 100 and sum(compared) < 3 * sum(near)


@pytest.mark.parametrize("chunk, met", [(2_000, 10_000), (7, 3)])
def test_leaders_meet_all_members_of_their_buckets(spark, monkeypatch, chunk, met):
    """In chunks and slices of any size, and once in the rows that come out."""
    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)
    monkeypatch.setattr(near_duplicates, "MET", met)
    rows = [(bucket, f"k{i}".encode(), f"k{i % 20}".encode(), 0.0, 1.0) for bucket in (1, 2, 3) for i in range(0, 30, bucket)]
    members = spark.createDataFrame(rows, "bucket bigint, key binary, root binary, own double, rest double")
    led = [(bucket, key, root, own, rest, sum(r[0] == bucket for r in rows)) for bucket, key, root, own, rest in rows
           if bucket < 3 and key in (b"k0", b"k4", b"k10", b"k24")]
    leaders = spark.createDataFrame(
        led, "bucket bigint, leader binary, leader_root binary, leader_own double, leader_rest double, size bigint")
    full = np.ones(near_duplicates.SKETCH_BINS, np.float16).tobytes()
    keys = {r[1] for r in rows}
    sketches = spark.createDataFrame([(key, full, float(near_duplicates.SKETCH_BINS)) for key in keys],
                                     "key binary, sketch binary, total double")
    distinct = spark.createDataFrame([(key, [1] * near_duplicates.SAMPLES) for key in keys], "key binary, samples array<bigint>")
    got = [(bytes(r.a), bytes(r.b)) for r in near_duplicates._candidates(members, leaders, distinct, sketches).collect()]
    wanted = {(min(r[1], s[1]), max(r[1], s[1])) for r in rows for s in led if r[0] == s[0] and r[2] != s[2]}
    assert len(got) == len(wanted) and set(got) == wanted
