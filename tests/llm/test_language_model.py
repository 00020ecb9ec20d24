from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import by_id, corpus, documents, empty
from usagemart.llm import language_model


def words(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def test_base_counts_equal_brute_force(spark):
    rows = corpus(spark).persist()
    listed = rows.select("doc_id", "text").collect()
    seen = Counter(w for r in listed if language_model.trains(r.doc_id) for w in words(r.text))
    n, v = sum(seen.values()), len(seen)
    got = language_model.scores(rows).collect()
    assert len(got) == len(listed)
    got = by_id(got)
    for row in listed:
        found, r = words(row.text), got[row.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(found), sum(seen[w] > 0 for w in found), n, not language_model.trains(row.doc_id))
        assert math.isclose(r.base_score, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in found), rel_tol=1e-9)
        assert r.score < 0 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9)


def test_held_out_texts_score_better_than_the_base(spark):
    got = language_model.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    base, score, n = got.selectExpr("sum(base_score)", "sum(score)", "sum(n_tokens)").first()
    assert score / n > base / n + 0.1


def test_probabilities_of_a_context_add_up():
    """All words of the vocabulary and the unknown word, after some sweeps."""
    dice = np.random.default_rng(2)
    words, restaurants = 40, 3
    restaurant, word = np.divmod(np.arange(restaurants * words), words)
    customers = dice.integers(1, 9, len(word)) ** 2
    seats = language_model.Seats(len(word), np.arange(len(word)), customers, 0.6, dice)
    root = language_model.Seats(words, np.arange(words), np.full(words, restaurants), 0.4, dice)
    totals = language_model.Totals(words, int(customers.sum()), 0.6, 0.4)
    for _ in range(3):
        totals.root_customers, totals.root_tables = int(root.customers().sum()), int(root.tables().sum())
        chance = totals.root_chance(root.customers(), root.tables())
        assert math.isclose(chance.sum() + totals.root_chance(0, 0), 1, rel_tol=1e-9)
        before = seats.tables()
        language_model.sweep_dishes(seats, restaurant, np.zeros(restaurants), chance[word])
        assert (seats.customers() == customers).all() and (seats.tables() >= 1).all()
        language_model.sweep_root(root, np.bincount(word, seats.tables() - before).astype(int), totals.opening)
        assert (root.customers() == np.bincount(word, seats.tables())).all()
    tables, total = seats.tables(), np.bincount(restaurant, customers)
    share = (1 + 0.6 * np.bincount(restaurant, tables)) / (1 + total)
    for u in range(restaurants):
        own = ((customers - 0.6 * tables) / (1 + total[restaurant]))[restaurant == u].sum()
        assert math.isclose(own + share[u], 1, rel_tol=1e-9)


def partitions(n):
    """Sizes of tables of ``n`` customers, and how many seatings have them."""
    def parts(left, most):
        if not left:
            yield ()
        for size in range(min(left, most), 0, -1):
            for rest in parts(left - size, size):
                yield (size, *rest)
    for sizes in parts(n, n):
        ways = math.factorial(n)
        for size in sizes:
            ways //= math.factorial(size)
        for times in Counter(sizes).values():
            ways //= math.factorial(times)
        yield sizes, ways


def exact_tables(n, others, discount, chance, strength=1.0):
    """Probability of each number of tables of a dish, over all seatings of its customers, given the other dishes."""
    found = Counter()
    for sizes, ways in partitions(n):
        weight = ways * math.prod((strength + discount * (others + j)) * chance for j in range(len(sizes)))
        weight *= math.prod(math.prod(k - discount for k in range(1, size)) for size in sizes)
        found[len(sizes)] += weight
    return np.array([found[t] / sum(found.values()) for t in range(n + 1)])


def test_moves_sample_the_exact_distribution():
    """Many restaurants with one dish that can move, beside dishes that cannot, against all seatings."""
    n, others, discount, chance, trials = 6, 4, 0.5, 0.3, 20_000
    seats = language_model.Seats(trials, np.arange(trials), np.full(trials, n), discount, np.random.default_rng(3))
    language_model.sweep_dishes(seats, np.arange(trials), np.full(trials, others), np.full(trials, chance), moves=60)
    got = np.bincount(seats.tables(), minlength=n + 1) / trials
    assert np.abs(got - exact_tables(n, others, discount, chance)).max() < 0.012
    sizes = Counter(tuple(sorted(seats.size[seats.dish == i])) for i in range(300))
    assert all(sum(size) == n for size in sizes)


def test_customers_of_the_root_come_and_go():
    dice = np.random.default_rng(4)
    seats = language_model.Seats(5, np.arange(5), np.array([1, 50, 200, 3, 1000]), 0.5, dice)
    change = np.array([0, -49, 900, 2, -1])
    language_model.sweep_root(seats, change, 0.7)
    assert seats.customers().tolist() == [1, 1, 1100, 5, 999] and (np.diff(seats.dish) >= 0).all()


def test_where_work_is_done_changes_no_count(spark, monkeypatch):
    """All restaurants hot, or none, in one part or many."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = []
    for hot, size in ((0, 10 ** 9), (10 ** 9, 3_000)):
        monkeypatch.setattr(language_model, "HOT", hot)
        monkeypatch.setattr(language_model, "PART_BYTES", size)
        monkeypatch.setattr(language_model, "SAMPLE", 1)
        found.append({r.doc_id: r for r in language_model.scores(rows).collect()})
    one, two = found
    assert all((one[i].n_known, one[i].base_score) == (two[i].n_known, two[i].base_score) for i in one)
    scores = [sum(r.score for r in rows.values()) / sum(r.n_tokens for r in rows.values()) for rows in found]
    assert abs(scores[0] - scores[1]) < 0.01


def test_no_training_rows(spark):
    assert language_model.scores(empty(spark)).collect() == []
    held = [i for i in range(100) if not language_model.trains(i)][:3]
    rows = documents(spark, ["a b", None, "c"]).selectExpr("doc_id - 10000000 AS i", "text")
    rows = rows.selectExpr(f"array({', '.join(map(str, held))})[CAST(i AS int)] AS doc_id", "text")
    got = language_model.scores(rows).collect()
    assert [(r.train_tokens, r.score, r.n_known) for r in got] == [(0, 0.0, 0)] * 3


@pytest.mark.parametrize("size", [1, 10 ** 9])
def test_blocks_do_not_matter_for_counts(spark, monkeypatch, size):
    monkeypatch.setattr(language_model, "BLOCK_BYTES", size)
    got = language_model.scores(documents(spark, ["a b a", "b c", "a a a b", "d"])).collect()
    assert sorted(r.n_tokens for r in got) == [2, 3, 4, 5]


def test_a_sweep_moves_every_customer():
    customers = np.array([1, 2, 7, 200, 1000])
    seats = language_model.Seats(5, np.arange(5), customers, 0.6, np.random.default_rng(5))
    asked = np.zeros(5, int)

    def opening(dish, own):
        np.add.at(asked, dish, 1)
        return np.full(len(dish), 0.3)

    seats.move(opening)
    assert asked.tolist() == [0, 2, 7, 200, 1000]  # one customer has one table whatever happens
    assert (seats.customers() == customers).all() and (np.diff(seats.dish) >= 0).all()


def test_frequent_dishes_open_as_many_tables_as_the_model_has():
    """Customers of one by one and of moves in groups, against the numbers of tables of all seatings; a few moves for each
    dish leave nearly all customers where they began, at one table."""
    def expected(n, others, discount, chance):
        tables, ways = np.arange(n + 2), np.full(n + 2, -np.inf)
        ways[1] = 0
        with np.errstate(divide="ignore"):
            for m in range(1, n):
                stay = np.log(np.maximum(m - discount * tables, 0)) + ways
                ways = np.logaddexp(stay, np.r_[-np.inf, ways[:-1]])
        weight = ways + np.r_[0, np.cumsum(np.log((1 + discount * (others + tables[:-1])) * chance))]
        share = np.exp(weight - weight.max())
        return (share * tables).sum() / share.sum()

    for n, others, discount, chance, trials in ((40, 30, 0.7, 0.01, 4000), (600, 500, 0.7, 0.02, 200)):
        seats = language_model.Seats(trials, np.arange(trials), np.full(trials, n), discount, np.random.default_rng(6))
        for _ in range(12):
            language_model.sweep_dishes(seats, np.arange(trials), np.full(trials, others), np.full(trials, chance))
        assert abs(seats.tables().mean() / expected(n, others, discount, chance) - 1) < 0.05


def test_blocks_number_the_tokens_of_their_texts():
    """Texts of a block are numbered together, each as ``tokens`` has it."""
    listed = ["", " ", "b A", " a\n\tB ", "É é\x1cx\u2028\x85 a", "\x0ba\x00b\x0c", "b"]
    for pieces in ([listed], [listed[:3], listed[3:]], [[""]], [["a"], []]):
        column = pa.chunked_array([pa.array(["unread", *piece]).slice(1) for piece in pieces])
        sizes, seen, known = language_model._numbered(column)
        wanted = [language_model.tokens(text) for piece in pieces for text in piece]
        assert sizes.tolist() == [*map(len, wanted)] and len(set(known)) == len(known) == len(set(seen.tolist()))
        assert [known[i] for i in seen] == [word for found in wanted for word in found]


@pytest.mark.parametrize("parts", [7, 1 << 40])
def test_pairs_are_put_in_order_of_their_parts(parts):
    dice = np.random.default_rng(8)
    part, first, second = (dice.integers(0, n, 3_000) for n in (parts, 5_000, 5_000))
    assert language_model._by_part(part, first, second, 5_000).tolist() == np.lexsort((second, first, part)).tolist()
