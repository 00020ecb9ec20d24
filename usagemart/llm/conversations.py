"""Repair of the structure of conversations, by Knuth's lightest derivations.

A conversation's rows, in order of their turns, are kept, given another role, deleted, or joined by inserted
empty messages, so that the initials of the roles read ``s?(ua)+`` or nothing is left. Costs are those of
``KEEP`` to ``INSERT``; of the cheapest repairs the one counts whose audit (initials of the edits, in order) is
the ASCII-least.

The deductive system has an item for each edit of a row, one for each message that may be inserted, and one
for each (rows read, last initial) that a prefix can end in. A deduction joins a prefix and an edit or an insertion
to a longer prefix; the weights (cost, audit) add up and follow each other. That function is superior: nothing
gets lighter by going on. And it is monotone: prefixes of one item and one cost cannot be beginnings of each other,
since their edits cost by letter alone, so what is appended never turns their order around. So an agenda that
pops the lightest item finalises each item with its least weight.

On Spark, equal rows of a turn are one row with a count, and rows are sorted over all tasks by conversation and turn, so
that a conversation of any length is cut into pieces. A piece that holds a whole conversation is solved at once. Of the
pieces of a longer one the lightest derivations between all pairs of ends are found, independently; only
these are chained, with what all surviving audits begin with dropped on the way, and each piece takes its own share
back. The digest of a whole conversation alone reads its pieces, streamed, in one task, as SHA-256 has no other way.

Defined cases: null role or text is a space (a text without words, a role that fits nowhere); null turns come
first, and rows of one turn are ordered by role and text; a null id names a conversation of its own, like any other;
repeated rows are duplicates; an empty table gives no rows. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from usagemart.llm.rows import SPACE_CHARS, small, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DAMAGES = 20
PIECE_ROWS, PIECE_BYTES = 256, 32_000
# Ends of a prefix of s?(ua)+ by their last initial, and what may follow.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
CLOSING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_LEGAL = ("su", "ua", "au")
_OK, _CUT, _GONE = range(3)  # a row as it is, a truncated one, one that must be deleted


# -- derivations ---------------------------------------------------------------------------------

def _edits(initial: str, kind: int) -> Iterator[tuple[str, str, int]]:
    """(letter, initial after it, cost) of the edits of a row; a deleted row has no initial."""
    yield "D", "", DELETE
    if kind != _GONE:
        more = TRUNCATED if kind == _CUT else 0
        yield "K", initial, KEEP + more
        yield "R", "u", REROLE + more
        yield "R", "a", REROLE + more


def lightest(rows: list[tuple[str, int]], start: int, closed: bool) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) from ``start`` over ``rows`` (initial, kind) to each end; only to the goal, named by START,
    if ``closed``."""
    n, agenda, final = len(rows), [(0, "", ("prefix", 0, start))], {}
    edits, prefixes, inserts = [[] for _ in rows], [[] for _ in range(n + 1)], []
    for i, row in enumerate(rows):
        agenda += [(cost, letter, ("edit", i, letter, after)) for letter, after, cost in _edits(*row)]
    agenda += [(INSERT, "I", ("insert", None, "I", initial)) for initial in "ua"]
    heapq.heapify(agenda)

    def deduce(prefix, step):
        """A prefix and an edit of its next row, or an insertion, are a prefix."""
        (_, i, end), (kind, _, _, initial) = prefix, step
        to = FOLLOWS.get((end, initial)) if initial else end if step[2] == "D" else None
        if to is not None:
            item = ("prefix", i + (kind == "edit"), to)
            if item not in final:
                (cost, audit), (more, letter) = final[prefix], final[step]
                heapq.heappush(agenda, (cost + more, audit + letter, item))

    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = cost, audit
        if item[0] == "goal":
            return {START: (cost, audit)}
        if item[0] == "prefix":
            _, i, end = item
            prefixes[i].append(item)
            for step in (*(edits[i] if i < n else ()), *inserts):
                deduce(item, step)
            if i == n and closed and end in (START, ASSISTANT):
                heapq.heappush(agenda, (cost, audit, ("goal",)))
            # Ends of an open piece are reached by a row's edit; what is inserted there belongs to the next piece.
            if i == n and not closed and (not n or not audit.endswith("I")):
                found[end] = cost, audit
        else:
            of_row = item[0] == "edit"
            (edits[item[1]] if of_row else inserts).append(item)
            for prefix in list(prefixes[item[1]]) if of_row else [p for listed in prefixes for p in listed]:
                deduce(prefix, item)
    return found


def repair(rows: Iterable[tuple[str, str]], audit: str, start: int = START) -> Iterator[tuple[str, str | None, str]]:
    """(edit, role, text) of each letter of ``audit``; the role of what is deleted is None."""
    end, rows = start, iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            yield letter, None, text
            continue
        if letter != "K":
            role = ROLES[FOLLOWS.get((end, "u")) or FOLLOWS[end, "a"]]
        end = FOLLOWS[end, role[:1]]
        yield letter, role, text


# -- rows ----------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows after the damage that a hash of (conv_id, turn) picks."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    picked = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % DAMAGES
    return conversations.select(
        "conv_id", "turn", F.when(picked == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        F.when(picked == 1, F.lit("")).when(picked == 2, F.regexp_replace(spaced("text"), "[.!?]", ""))
        .otherwise(spaced("text")).alias("text"),
        F.when(picked == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"), picked.alias("picked"),
    ).where("picked != 0").drop("picked")


def faults(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, last, seen): equal rows of a turn are one; ``last``: the text's last character
    that is no white space; ``seen``: role and text occur in an earlier turn of the conversation."""
    once = stored(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                  .withColumn("key", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))), "rows")
    placed = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    first = once.groupBy("conv_id", "key").agg(F.min(placed).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("conv_id").alias("_conv_id"), F.col("key").alias("_key"), "first")
    joined = once.join(first, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("key") == F.col("_key")), "left")
    blanks = F.lit(SPACE_CHARS)
    return joined.select(
        "conv_id", "turn", "role", "text", "copies", F.substring(F.rtrim("text", blanks), -1, 1).alias("last"),
        (F.col("first").isNotNull() & ~placed.eqNullSafe(F.col("first"))).alias("seen"))


# -- pieces --------------------------------------------------------------------------------------

_PATHS = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("cost", "long").add("audit", "string"))
_ROWS = T.ArrayType(T.StructType().add("role", "string").add("text", "string"))


def _piece_type(conv_id: T.StructField, turn: T.StructField) -> T.StructType:
    """A piece: its place, its rows, the derivations over it, and what its conversation's figures need."""
    kind = T.StructType([T.StructField("conv_id", conv_id.dataType)]).add("part", "integer").add("number", "integer")
    kind = kind.add("whole", "boolean").add("rows", _ROWS).add("paths", _PATHS)
    for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
        kind = kind.add(name, "long")
    kind = kind.add("first_initial", "string").add("last_initial", "string")
    return kind.add(T.StructField("first_turn", turn.dataType)).add(T.StructField("last_turn", turn.dataType))


class _Piece:
    def __init__(self):
        self.rows, self.kinds, self.size = [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn, role: str, text: str, last: str, seen: bool) -> None:
        blank, duplicate = last == "", last != "" and seen
        cut = not blank and not duplicate and last not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if self.rows:
            self.illegal += self.rows[-1][0][:1] + role[:1] not in _LEGAL
        gone = blank or duplicate
        self.rows.append((role, "" if gone else text))
        self.kinds.append((role[:1], _GONE if gone else _CUT if cut else _OK))
        self.size += 0 if gone else len(text)
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn

    def row(self, conv_id, part: int, number: int, whole: bool) -> dict:
        ends = ({START: lightest(self.kinds, START, True)} if whole else
                {start: lightest(self.kinds, start, False) for start in range(4)})
        return {
            "conv_id": conv_id, "part": part, "number": number, "whole": whole,
            "rows": [{"role": role, "text": text} for role, text in self.rows],
            "paths": [{"start": p, "end": q, "cost": cost, "audit": audit}
                      for p, found in ends.items() for q, (cost, audit) in found.items()],
            **{name: getattr(self, name) for name in ("blank", "duplicate", "truncated", "illegal", "turns",
                                                      "first_turn", "last_turn")},
            "first_initial": self.rows[0][0][:1], "last_initial": self.rows[-1][0][:1]}


def _cut(schema: pa.Schema):
    """Sorted rows of a task as pieces. The first and the last conversation may go on in other tasks."""
    def task(batches):
        part, ready, number = TaskContext.get().partitionId(), [], 0
        piece, conv_id, first, cut = None, None, True, False
        for batch in small(batches):
            for row in batch.to_pylist():
                if piece is not None and row["conv_id"] != conv_id:
                    ready.append(piece.row(conv_id, part, number, not first and not cut))
                    piece, first, cut = None, False, False
                for copy in range(row["copies"]):
                    if piece is not None and (len(piece.rows) >= PIECE_ROWS or piece.size >= PIECE_BYTES):
                        ready.append(piece.row(conv_id, part, number, False))
                        piece, cut = None, True
                    if piece is None:
                        piece, conv_id, number = _Piece(), row["conv_id"], number + 1
                    piece.add(row["turn"], row["role"], row["text"], row["last"], row["seen"] or copy > 0)
                    if len(ready) >= 200:
                        yield pa.RecordBatch.from_pylist(ready, schema)
                        ready = []
        if piece is not None:
            ready.append(piece.row(conv_id, part, number, False))
        yield pa.RecordBatch.from_pylist(ready, schema)
    return task


def _grouped(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[bool, dict]]:
    """Rows with whether they begin another conversation than the row before."""
    last = object()
    for batch in small(batches, rows):
        for row in batch.to_pylist():
            yield row["conv_id"] != last, row
            last = row["conv_id"]


def _chain(schema: pa.Schema):
    """Which derivation each piece of a split conversation takes: its ends, and what closes the last one."""
    def choices(places, back, best):
        end, (cost, audit) = min(((end, (cost + INSERT * len(CLOSING[end]), audit + CLOSING[end]))
                                  for end, (cost, audit) in best.items()), key=lambda found: found[1])
        closing, chosen = CLOSING[end], []
        for (conv_id, part, number), origins in zip(reversed(places), reversed(back)):
            chosen.append({"conv_id": conv_id, "part": part, "number": number, "start": origins[end], "end": end,
                           "closing": closing})
            end, closing = origins[end], ""
        return chosen

    def task(batches):
        places, back, best = [], [], {}
        for new, row in _grouped(batches, 500):
            if new and places:
                yield pa.RecordBatch.from_pylist(choices(places, back, best), schema)
            if new:
                places, back, best = [], [], {START: (0, "")}
            found = {}
            for path in row["paths"]:
                if path["start"] in best:
                    cost, audit = best[path["start"]]
                    weight = cost + path["cost"], audit + path["audit"], path["start"]
                    if path["end"] not in found or weight < found[path["end"]]:
                        found[path["end"]] = weight
            # What all survivors begin with decides nothing any more.
            shared = len(os.path.commonprefix([audit for _, audit, _ in found.values()]))
            best = {end: (cost, audit[shared:]) for end, (cost, audit, _) in found.items()}
            places.append((row["conv_id"], row["part"], row["number"]))
            back.append({end: start for end, (_, _, start) in found.items()})
        if places:
            yield pa.RecordBatch.from_pylist(choices(places, back, best), schema)
    return task


def _arrow(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(kind)


def solved(conversations: DataFrame) -> DataFrame:
    """Every piece with the derivation that it takes (``start``, ``audit``, ``cost``); pieces of a conversation are in order
    of ``part`` and ``number``. Split conversations alone are shuffled once more."""
    rows = stored(faults(damaged(conversations)), "faults")
    kind = _piece_type(rows.schema["conv_id"], rows.schema["turn"])
    order = ["conv_id", "turn", "role", "text"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(ordered.mapInArrow(_cut(_arrow(kind)), kind), "pieces")
    whole = pieces.where("whole").withColumns({
        "start": F.lit(START), "audit": F.col("paths")[0]["audit"], "cost": F.col("paths")[0]["cost"]})
    split = pieces.where("NOT whole")
    chosen = T.StructType([kind["conv_id"]]).add("part", "integer").add("number", "integer").add("start", "integer").add(
        "end", "integer").add("closing", "string")
    chain = split.select("conv_id", "part", "number", "paths").repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", "number").mapInArrow(_chain(_arrow(chosen)), chosen)
    chain = chain.select("part", "number", F.col("start").alias("_start"), F.col("end").alias("_end"), "closing")
    path = F.filter("paths", lambda p: (p["start"] == F.col("_start")) & (p["end"] == F.col("_end")))[0]
    # A piece's place names it.
    split = split.join(chain, ["part", "number"]).withColumns({
        "start": F.col("_start"), "audit": F.concat(path["audit"], F.col("closing")),
        "cost": path["cost"] + INSERT * F.length("closing")}).drop("_start", "_end", "closing")
    return stored(whole.unionByName(split.select(whole.columns)).drop("paths"), "solved")


# -- results -------------------------------------------------------------------------------------

def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, part, number, place, edit, role, text): every row kept, changed, deleted (role null) or inserted,
    in order of part, number and place."""
    pieces = solved(conversations).select("conv_id", "part", "number", "start", "audit", "rows")
    kind = T.StructType([pieces.schema["conv_id"]]).add("part", "integer").add("number", "integer").add("place", "integer").add(
        "edit", "string").add("role", "string").add("text", "string")
    schema = _arrow(kind)

    def task(batches):
        for batch in small(batches, 50):
            yield pa.RecordBatch.from_pylist([
                {"conv_id": row["conv_id"], "part": row["part"], "number": row["number"], "place": place, "edit": edit,
                 "role": role, "text": text}
                for row in batch.to_pylist() for place, (edit, role, text) in enumerate(
                    repair(((r["role"], r["text"]) for r in row["rows"]), row["audit"], row["start"]))], schema)

    return pieces.mapInArrow(task, kind)


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _summed(schema: pa.Schema):
    """Pieces in order, as a row for each conversation; its texts pass through, its audit stays."""
    class Sum:
        def __init__(self, row):
            self.conv_id, self.audit, self.hash, self.any = row["conv_id"], [], hashlib.sha256(), False
            self.figures = dict.fromkeys((*_FIGURES, "turns"), 0)
            self.least = self.most = self.initial = None

        def add(self, row):
            for name in ("blank", "duplicate", "truncated", "illegal", "turns", "cost"):
                self.figures[name] += row[name]
            if self.initial is not None:
                self.figures["illegal"] += self.initial + row["first_initial"] not in _LEGAL
            self.initial = row["last_initial"]
            if row["turns"]:
                self.figures["turns"] -= row["first_turn"] == self.most
                self.least = row["first_turn"] if self.least is None else self.least
                self.most = row["last_turn"]
            self.audit.append(row["audit"])
            for _, role, text in repair(((r["role"], r["text"]) for r in row["rows"]), row["audit"], row["start"]):
                if role is not None:
                    self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
                    self.any = True

        def row(self):
            turns = self.figures.pop("turns")
            self.figures["gaps"] = self.most - self.least + 1 - turns if turns else 0
            return {"conv_id": self.conv_id, **self.figures, "audit": "".join(self.audit),
                    "repaired_sha256": self.hash.hexdigest()}

    def task(batches):
        now, ready = None, []
        for new, row in _grouped(batches, 50):
            if new and now:
                ready.append(now.row())
            if len(ready) >= 500:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready = []
            if new:
                now = Sum(row)
            now.add(row)
        if now:
            ready.append(now.row())
        yield pa.RecordBatch.from_pylist(ready, schema)
    return task


def digest(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    pieces = solved(conversations)
    kind = T.StructType([pieces.schema["conv_id"]])
    for name in _FIGURES:
        kind = kind.add(name, "long")
    kind = kind.add("audit", "string").add("repaired_sha256", "string")
    task = _summed(_arrow(kind))
    split = pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    found = pieces.where("whole").mapInArrow(task, kind).unionByName(split.mapInArrow(task, kind))
    ids = conversations.select("conv_id").distinct()
    found = found.withColumnRenamed("conv_id", "_conv_id")

    def or_else(name: str, value) -> Column:
        return F.coalesce(F.col(name), F.lit(value)).alias(name)

    return ids.join(found, ids["conv_id"].eqNullSafe(found["_conv_id"]), "left").select(
        "conv_id", *(or_else(name, 0).cast("long").alias(name) for name in _FIGURES), or_else("audit", ""),
        or_else("repaired_sha256", hashlib.sha256().hexdigest()))
