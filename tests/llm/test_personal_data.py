from __future__ import annotations

import hashlib
import random
import re

import pytest

from tests.llm.cases import by_id, clashing, corpus, documents, empty
from usagemart.llm import personal_data

PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"[0-9]([\x20-]?[0-9])+"),
            re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]
ODD = ["😀 a@b@c.com x..y@z.de 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +49 (30) 1234-5678.",
       "+1+2+3456789012 1" + "1" * 3000 + " " + "a" * 3000 + "@" + " 12@3.4", "0256.1.1.1 00001.2.3.4 1.2.3.4.",
       "5500-0000-0000-0004 5500 0000 0000 0005 12@a.b.c@d.e", "+1234567 +12345678 +123456789 +1 (2) 3-4.5 6 7 8 9 0 1 2 3 4 5 6"]


def digits(text):
    return re.sub("[^0-9]", "", text)


TESTS = [lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")),
         lambda s: 12 <= len(digits(s)) <= 19 and personal_data.luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15]


def text_of(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_equals_the_patterns(spark):
    rows = corpus(spark).select("doc_id", "text").unionByName(
        documents(spark, ODD, 20_000_000).select("doc_id", "text")).persist()
    field = personal_data.learn(rows)
    got = personal_data.digest(personal_data.find(clashing(rows), field)).collect()
    assert len(got) == rows.count()
    got = by_id(got)
    for row in rows.collect():
        text = row.text or ""
        wanted = sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text) if TESTS[k](m[0]))
        r = got[row.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, x, _ in wanted) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(text_of(wanted).encode()).hexdigest()
        assert {*text_of(wanted).split(",")} <= {*r.spans.split(","), ""}


def marked_texts(n, seed):
    dice = random.Random(seed)
    texts = []
    for _ in range(n):
        words = [f"{dice.choice('bcdfg')}{dice.choice('aeiou')}{dice.choice('lmnrst')}" for _ in range(30)]
        words[5] = f"{words[0]}.{words[1]}{dice.randrange(99)}@mail{dice.randrange(9)}.example.com"
        words[12] = f"+1 ({dice.randrange(100, 999)}) 555-{dice.randrange(1000, 9999)}"
        words[18] = ".".join(str(dice.randrange(256)) for _ in range(4))
        words[24] = str(dice.randrange(10, 9999))
        texts.append(" ".join(words))
    return texts


def test_the_field_finds_held_out_entities_by_itself_and_new_spellings(spark):
    field = personal_data.learn(documents(spark, marked_texts(400, 1)))
    hit = total = false = 0
    for text in marked_texts(60, 2):
        base, found = set(personal_data.base_spans(text)), set(personal_data.all_spans(text, [], field))
        hit, total, false = hit + len(base & found), total + len(base), false + len(found - base)
    assert hit >= 0.95 * total and false <= 0.05 * total
    text = "bal ber please call 001 (312) 555-1234 dor bel or write to bob.lee7(at)mail3.example.com fan gal"
    kinds = {personal_data.KINDS[k]: text[a:b] for a, k, b in personal_data.all_spans(text, personal_data.base_spans(text), field)}
    assert kinds == {"phone": "001 (312) 555-1234", "email": "bob.lee7(at)mail3.example.com"}


def test_best_segmentation_equals_trying_all():
    field = personal_data.Field()
    dice = random.Random(6)
    for i in range(0, len(field.weights), 3):
        field.weights[i] = dice.uniform(-1, 1)
    words = ["a", "12", "x@y", "b", "7"]
    table = field.scores(words)

    def every(i):
        if i == len(words):
            yield 0.0, []
        for (a, j, label), score in table.items():
            if a == i:
                for rest, path in every(j):
                    yield score + rest, [(a, j, label), *path]

    score, path = max(every(0), key=lambda x: x[0])
    assert [(a, j, label) for a, j, label, _ in field.best(words)] == [s for s in path if s[2]]
    ahead, back = field.sums(table, len(words))
    assert ahead[-1] == pytest.approx(personal_data._log_sum([s for s, _ in every(0)])) == pytest.approx(back[0])


def test_windows_do_not_overlap_and_hold_every_anchor():
    dice = random.Random(5)
    for _ in range(200):
        text = "".join(dice.choice("ab1@ \n") if dice.random() < .3 else dice.choice("abc ") for _ in range(dice.randrange(900)))
        spans = [span for window in personal_data.windows(text) for span in window]
        assert spans == sorted(set(spans)) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert all(any(a <= m.start() < b for a, b in spans) for m in re.finditer("[0-9@]", text))


def test_empty_table_and_nothing_to_learn(spark):
    assert personal_data.learn(empty(spark)) is None
    assert personal_data.find(empty(spark), None).collect() == []
    assert personal_data.find(documents(spark), None).count() == documents(spark).count()


def test_a_copied_window_counts_once(spark):
    rows = documents(spark, ["mail me at a.b@c.example.com now"] * 200 + marked_texts(30, 3))
    listed = [tuple(words) for words, _ in personal_data.sample_windows(rows, 20)]
    assert len(listed) == len(set(listed)) == 20


def test_long_windows_teach_in_pieces():
    text = " ".join(f"mail{i}@example.org or +49 30 {1000000 + i}," for i in range(200))
    base = personal_data.base_spans(text)
    whole, = personal_data.windows(text)
    pieces = personal_data._pieces(whole, base)
    assert [s for piece in pieces for s in piece] == whole and max(map(len, pieces)) < 70 and len(pieces) > 5
    assert sum(len(personal_data._sequence(text, piece, base)[1]) for piece in pieces) == len(base)
