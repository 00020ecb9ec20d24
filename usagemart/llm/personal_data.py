"""Personal data: fixed patterns, and spans that a semi-Markov conditional random field adds.

The field scores whole segments: outside words one by one, and candidate entities of up to
``MAX_WORDS`` words with features of the span as a whole (its shape, digits, separators, the words
beside it). Dynamic programming over boundaries and kinds finds the best segmentation; training
maximises the likelihood of segmentations with forward and backward sums over the same segments.

Texts have no marked entities, so the patterns' matches in a sample teach the field, of at most
``SAMPLE_WINDOWS`` windows of words, the least by a hash. So that it learns what spans look like beyond the
patterns, copies of the windows lose what the patterns insist on: a leading plus, the at sign, a
card's closed digits. The sample bounds what the driver reads; every executor gets the weights, whose
number is fixed by hashing.

Defined cases: null text is empty; repeated rows each get the same result; a text of any length is
segmented window by window around the words that can begin or end an entity, and windows do not
overlap; without any match to learn from, the field adds nothing. Features take the first 40 letters of a segment's
shape, 8 kinds of marks and 12 letters of the words beside it. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.llm.rows import small, texts

KINDS = ["email", "ip", "card", "phone"]
MAX_WORDS, MARGIN = 6, 3
SAMPLE_WINDOWS, PIECE_WORDS = 1_500, 60
WEIGHT_BITS = 16
MIN_SHARE = 0.9  # an added span must be as likely as that, given its window

# The patterns of the contract.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ANCHOR = re.compile(r"[0-9@]|[(\[]at[)\]]")
_PIECE = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?\"'()[]<>{}|"


# -- patterns ----------------------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches around each at sign in turn, so that long runs without one cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's rank, end) of all matches of the patterns, sorted."""
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
              if all(len(part.lstrip("0")) < 4 and int(part) <= 255 for part in m.groups())]
    for match in _CARD.finditer(text):
        digits = _digits(match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


# -- windows and features ----------------------------------------------------------------------

def windows(text: str) -> Iterator[list[tuple[int, int]]]:
    """Lists of (start, end) of words: those with a digit or an at sign, and those close around them."""
    words: list[tuple[int, int]] = []
    taken = 0  # up to here, words are in a window already
    for anchor in _ANCHOR.finditer(text):
        if anchor.start() < taken:
            continue
        start = anchor.start()
        while start > taken and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        between = [m.span() for m in _PIECE.finditer(text, max(taken, start - 200), start)]
        if words and (start - taken > 200 or len(between) > 2 * MARGIN):
            words += _after(text, taken)
            yield words
            between = [span for span in between if span[0] >= words[-1][1]]
            words = []
        words += between if words else between[-MARGIN:]
        words.append(_PIECE.match(text, start).span())
        taken = words[-1][1]
    if words:
        yield words + _after(text, taken)


def _after(text: str, end: int) -> list[tuple[int, int]]:
    """Up to ``MARGIN`` words that follow, as far as they begin nearby and hold no anchor."""
    found = []
    for match in _PIECE.finditer(text, end, end + 100):
        if len(found) == MARGIN or _ANCHOR.search(match[0]) or match.end() == end + 100:
            break
        found.append(match.span())
    return found


def _slot(feature: str) -> int:
    return crc32(feature.encode()) & ((1 << WEIGHT_BITS) - 1)


def _shape(text: str) -> str:
    runs = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 9)}", text[:200]))
    return runs[:40]


def span_features(words: list[str], i: int, j: int) -> list[str]:
    """Features of the words i to j as one segment; a kind is joined to each."""
    span = " ".join(words[i:j]).strip(_EDGE)
    digits = _digits(span)
    parts = span.split(".")
    marks = "".join(sorted({c for c in span if not c.isalnum()}))[:8]
    found = ["bias", f"shape={_shape(span)}", f"digits={min(len(digits), 20)}", f"marks={marks}", f"words={j - i}",
             f"marks+digits={marks}{min(len(digits), 20)}", f"bare={re.sub('[0-9]+', 'd', _shape(span))}",
             f"before={words[i - 1].lower()[:12] if i else '^'}",
             f"after={words[j].lower()[:12] if j < len(words) else '$'}"]
    if 12 <= len(digits) <= 19:
        found.append(f"luhn={luhn(digits)}")
    if len(parts) == 4 and all(part.isascii() and part.isdigit() for part in parts):
        found.append(f"octets={all(len(part) < 4 and int(part) <= 255 for part in parts)}")
    if "@" in span or re.search(r"[(\[ ]at[)\] ]", span):
        found.append(f"mail={bool(re.search(r'[.]|dot', span.partition('@')[2] or span))}")
    return found


class Field:
    """Weights of a semi-Markov conditional random field; label 0 is outside, others are kinds."""

    def __init__(self, weights: np.ndarray | None = None):
        self.weights = np.zeros(1 << WEIGHT_BITS) if weights is None else weights

    def scores(self, words: list[str], slots: bool = False):
        """Score of each segment (i, j, label); outside segments are one word long."""
        table, used, labels = {}, {}, range(len(KINDS) + 1)
        hopeful = [bool(_ANCHOR.search(word)) for word in words]
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + MAX_WORDS) + 1):
                inside = any(hopeful[i:j])
                if j > i + 1 and not inside:
                    continue
                names = span_features(words, i, j)
                for label in labels:
                    if (label == 0) != (j == i + 1) and label == 0 or label and not inside:
                        continue
                    at = [_slot(f"{label}|{name}") for name in names]
                    table[i, j, label] = float(self.weights[at].sum())
                    if slots:
                        used[i, j, label] = at
        return (table, used) if slots else table

    @staticmethod
    def sums(table: dict, n: int) -> tuple[list[float], list[float]]:
        """Log sums over all segmentations up to, and from, each boundary."""
        ends, begins = {}, {}
        for (i, j, _), score in table.items():
            ends.setdefault(j, []).append((i, score))
            begins.setdefault(i, []).append((j, score))
        ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[i] + score for i, score in ends[j]])
        for i in range(n - 1, -1, -1):
            back[i] = _log_sum([back[j] + score for j, score in begins[i]])
        return ahead, back

    def best(self, words: list[str]) -> list[tuple[int, int, int, float]]:
        """Entities (i, j, label, share) of the best segmentation; share: probability of the segment."""
        n, table = len(words), self.scores(words)
        ends = {}
        for (i, j, label), score in table.items():
            ends.setdefault(j, []).append((i, label, score))
        value, back = [0.0] * (n + 1), [(0, 0)] * (n + 1)
        for j in range(1, n + 1):
            value[j], *rest = max((value[i] + score, i, label) for i, label, score in ends[j])
            back[j] = tuple(rest)
        found, j = [], n
        while j:
            i, label = back[j]
            if label:
                found.append((i, j, label))
            j = i
        if not found:
            return []
        ahead, behind = self.sums(table, n)
        return [(i, j, label, math.exp(ahead[i] + table[i, j, label] + behind[j] - ahead[n]))
                for i, j, label in reversed(found)]

    def fit(self, sequences: list[tuple[list[str], set]], rounds: int = 3, rate: float = 0.2) -> Field:
        """Stochastic gradient of the log likelihood with adaptive steps; the same data give the same weights."""
        seen = np.full(1 << WEIGHT_BITS, 1e-6)
        dice = random.Random(5)
        for _ in range(rounds):
            dice.shuffle(sequences)
            for words, gold in sequences:
                table, used = self.scores(words, slots=True)
                ahead, back = self.sums(table, len(words))
                inside = {w for i, j, _ in gold for w in range(i, j)}
                slots, steps = [], []
                for key, score in table.items():
                    i, j, label = key
                    share = math.exp(min(0.0, ahead[i] + score + back[j] - ahead[-1]))
                    wanted = key in gold if label else i not in inside
                    if abs(wanted - share) > 1e-4:
                        slots += used[key]
                        steps += [wanted - share] * len(used[key])
                if slots:
                    gradient = np.bincount(slots, steps, 1 << WEIGHT_BITS)
                    at = np.flatnonzero(gradient)
                    seen[at] += gradient[at] ** 2
                    self.weights[at] += rate * gradient[at] / np.sqrt(seen[at])
        return self


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(value - top) for value in values))


# -- learning ----------------------------------------------------------------------------------

def _sequence(text: str, spans: list[tuple[int, int]], base) -> tuple[list[str], list[list[int]]]:
    """Words of a window and the base spans in it as [first word, last word + 1, label]."""
    words = [text[a:b] for a, b in spans]
    gold = []
    for start, rank, end in base:
        at = [k for k, (a, b) in enumerate(spans) if a < end and start < b]
        if at and len(at) <= MAX_WORDS and spans[at[0]][0] <= start and end <= spans[at[-1]][1]:
            if not gold or gold[-1][1] <= at[0]:
                gold.append([at[0], at[-1] + 1, rank + 1])
    return words, gold


def _rewritten(words: list[str], gold: list[list[int]], dice: random.Random) -> list[str]:
    """The same words, but entities written in ways that the patterns do not know."""
    words = list(words)
    for i, j, label in gold:
        if label == 1:
            words[j - 1] = words[j - 1].replace("@", dice.choice(["(at)", "[at]"]))
        elif label == 3 and j == i + 1:
            words[i] = re.sub(r"([0-9]{4})(?=[0-9])", dice.choice([r"\1.", r"\1_"]), words[i])
        elif label == 4 and words[i].startswith("+"):
            words[i] = "00" + words[i][1:]
    return words


def _pieces(spans: list, base: list) -> list[list]:
    """A window as pieces of ``PIECE_WORDS`` words, or of more where a match of the patterns goes on."""
    pieces, at = [], 0
    while at < len(spans):
        end = min(at + PIECE_WORDS, len(spans))
        while end < len(spans):
            before = bisect_left(base, (spans[end][0],))
            if not any(s[2] > spans[end][0] for s in base[max(before - 8, 0):before]):
                break
            end += 1
        pieces.append(spans[at:end])
        at = end
    return pieces


def sample_windows(documents: DataFrame, rows: int = SAMPLE_WINDOWS) -> list[tuple[list[str], list]]:
    def task(batches):
        for batch in small(batches):
            found, golds, order = [], [], []
            for text in batch.column("text").to_pylist():
                if not _ANCHOR.search(text):
                    continue
                base = base_spans(text)
                for spans in (part for whole in windows(text) for part in _pieces(whole, base)):
                    near = base[bisect_left(base, (spans[0][0],)):bisect_left(base, (spans[-1][1],))]
                    words, gold = _sequence(text, spans, near)
                    found.append(words)
                    golds.append(gold)
                    mark = hashlib.md5(" ".join(words).encode()).digest()
                    order.append(int.from_bytes(mark[:8], "big", signed=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(order, pa.int64()), pa.array(found, pa.list_(pa.string())),
                 pa.array(golds, pa.list_(pa.list_(pa.int32())))], ["mark", "words", "gold"])

    picked = texts(documents).mapInArrow(task, "mark bigint, words array<string>, gold array<array<int>>")
    # A window that is copied counts once, and each task sends it once.
    once = picked.groupBy("mark").agg(F.min(F.struct("words", "gold")).alias("window"))
    least = once.orderBy("mark").limit(rows).select("window.*").collect()
    return [(row.words, row.gold) for row in least]


def learn(documents: DataFrame, rows: int = SAMPLE_WINDOWS) -> Field | None:
    sample = sample_windows(documents, rows)
    if not any(gold for _, gold in sample):
        return None
    dice, sequences = random.Random(7), []
    for words, gold in sample:
        entities = {tuple(one) for one in gold}
        sequences.append((words, entities))
        if gold and dice.random() < 0.5:
            sequences.append((_rewritten(words, gold, dice), entities))
    return Field().fit(sequences)


# -- finding -----------------------------------------------------------------------------------

def all_spans(text: str, base: list[tuple[int, int, int]], field: Field | None) -> list[tuple[int, int, int]]:
    """The patterns' spans and those of the field that overlap none of them, sorted."""
    found = list(base)
    if field is not None and _ANCHOR.search(text):
        for spans in windows(text):
            words = [text[a:b] for a, b in spans]
            for i, j, label, share in field.best(words):
                start, end = spans[i][0], spans[j - 1][1]
                body = text[start:end]
                start += len(body) - len(body.lstrip(_EDGE))
                end -= len(body) - len(body.rstrip(_EDGE))
                if share >= MIN_SHARE and start < end and not any(a < end and start < b for a, _, b in base):
                    found.append((start, label - 1, end))
    return sorted(found)


def find(documents: DataFrame, field: Field | None) -> DataFrame:
    """(doc_id, base, spans) of every row; both are arrays of (start, end, kind)."""
    rows = texts(documents)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(None if field is None else field.weights)  # of fixed size
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def named(spans):
        return [{"start": a, "end": b, "kind": KINDS[rank]} for a, rank, b in spans]

    def task(batches):
        known = None if shared.value is None else Field(shared.value)
        for batch in small(batches):
            bases, alls = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                bases.append(named(base))
                alls.append(named(all_spans(text, base, known)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(bases, kind), pa.array(alls, kind)], ["doc_id", "base", "spans"])

    spans = T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("kind", T.StringType())]))
    return rows.mapInArrow(task, T.StructType([
        rows.schema["doc_id"], T.StructField("base", spans), T.StructField("spans", spans)]))


def digest(found: DataFrame) -> DataFrame:
    def text_of(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *(count(kind) for kind in KINDS),
                        F.sha2(text_of("base").cast("binary"), 256).alias("base_sha256"),
                        text_of("spans").alias("spans"))
