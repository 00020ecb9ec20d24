from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

import __spark_entry__ as driver
from tests.compare import spark_rows, sql_rows
from tests.llm.cases import clashing
from usagemart.llm import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GOAL, SPACE = re.compile("(s?(ua)+)?"), " \t\n\x0b\x0c\r"
INSERTED = [("user", ""), ("assistant", "")]


def after_damage(rows):
    found = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        picked = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        row = (turn, "user" if picked == 4 else role,
               "" if picked == 1 else re.sub("[.!?]", "", text) if picked == 2 else text)
        found += [row] * (0 if picked == 0 else 2 if picked == 3 else 1)
    return sorted(found, key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))


def kinds(rows):
    seen, found = set(), []
    for _, role, text in rows:
        end = text.strip(SPACE)[-1:]
        found.append("blank" if not end else "duplicate" if (role, text) in seen else
                     "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return found


def by_trying_all(rows):
    """Every sequence of edits with up to two insertions in a place."""
    best, gaps = None, [list(g) for n in range(3) for g in itertools.product(INSERTED, repeat=n)]
    choices = []
    for (_, role, text), kind in zip(rows, kinds(rows)):
        more = 3 if kind == "truncated" else 0
        choices.append([("D", 4, [])] + ([] if kind in ("blank", "duplicate") else [
            ("K", more, [(role, text)]), ("R", 3 + more, [("user", text)]), ("R", 3 + more, [("assistant", text)])]))
    for edits in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            cost = sum(e[1] for e in edits) + 3 * sum(map(len, inserted))
            if best and cost > best[0]:
                continue
            audit, out = "I" * len(inserted[0]), list(inserted[0])
            for (letter, _, kept), more in zip(edits, inserted[1:]):
                audit, out = audit + letter + "I" * len(more), out + kept + more
            if GOAL.fullmatch("".join(role[:1] or "?" for role, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, out
    return best


def expected(rows):
    rows = after_damage(rows)
    found, turns = kinds(rows), {turn for turn, _, _ in rows if turn is not None}
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, out = by_trying_all(rows)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *map(found.count, ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest())


def figures(frame):
    found = {row.conv_id: tuple(row)[1:] for row in conversations.digest(frame).collect()}
    return found


def test_cheapest_repairs_equal_trying_all(spark):
    dice = random.Random(5)
    texts = ["Hi.", "Yes!", "cut off", " \t", None, "", "What? ", "and so on ..", "é 😀"]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", None, "", "ugly"]
    rows = []
    for conv_id in [None, *range(60)]:
        turns = sorted(dice.choices([None, 0, 1, 2, 5, 5], k=dice.randint(1, 3)), key=lambda t: t or 0)
        rows += [(conv_id, turn, dice.choice(roles), dice.choice(texts)) for turn in turns]
    frame = clashing(spark.createDataFrame(rows, SCHEMA))
    want = {conv_id: expected([r for r in rows if r[0] == conv_id]) for conv_id in {r[0] for r in rows}}
    assert figures(frame) == want


@pytest.mark.parametrize("rows_in_piece", [1, 2, 7])
def test_pieces_make_no_difference(spark, monkeypatch, rows_in_piece):
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    # All in one conversation, and the usual ones.
    one = given.selectExpr("CAST(NULL AS BIGINT) AS conv_id", "conv_id * 100 + turn AS turn", "role", "text")
    frame = given.unionByName(one).unionByName(one.limit(3)).persist()
    want = figures(frame)
    monkeypatch.setattr(conversations, "PIECE_ROWS", rows_in_piece)
    assert figures(frame) == want
    texts = {}
    for row in sorted(conversations.repaired(frame).where("role IS NOT NULL").collect(),
                      key=lambda r: (r.part, r.number, r.place)):
        texts.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    assert {i: hashlib.sha256("\n".join(texts.get(i, [])).encode()).hexdigest() for i in want} == {
        i: row[-1] for i, row in want.items()}


def test_many_copies_are_one_row_until_they_are_cut(spark):
    spared = next(i for i in range(1000) if all(zlib.crc32(f"{i}:{turn}".encode()) % 20 > 4 for turn in (7, 8)))
    rows = [(spared, 7, "user", "Again and again.")] * 5_000 + [(spared, 8, "assistant", "So.")]
    got = figures(spark.createDataFrame(rows, SCHEMA))[spared]
    assert got[:-1] == (0, 0, 4_999, 0, 4_999, 4 * 4_999, "K" + "D" * 4_999 + "K")


def test_nothing_left_and_empty_table(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)
    assert figures(frame) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert figures(spark.createDataFrame([], SCHEMA)) == {}


def test_same_answer_as_sql(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert spark_rows(driver.queries()["op12_conversations"](spark, folder)) == sql_rows(
            folder, driver.oracle_sql()["op12_conversations"])
