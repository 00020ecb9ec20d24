"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

Folding maps compatibility forms and homoglyphs to plain letters and undoes digit substitutions in
words that mix letters and digits, so that a disguised word meets its plain entry. The lexicon holds
words and word beginnings with their log odds, and phrases that excuse an entry inside them. Both are
learnt from labelled texts, as is the logistic curve that turns the matched weight, absolute and
relative to the length, into a probability.

Learning reads a sample of at most ``SAMPLE_ROWS`` labelled rows, the least by a hash of the id; this
bounds the labels sent to all executors, the lexicon and the rows that the curve is fitted to.

Defined cases: null text is empty; an empty text scores like any text without matches; labels that
contradict each other for an id count once each; rows without label are scored like others; without
labels of both kinds the lexicon is empty and every score is the share of toxic labels (0 without
labels). Only ``doc_id`` and ``text``, and ``doc_id`` and ``toxic`` of the labels, are read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.llm.rows import learns, small, stored, texts

SAMPLE_ROWS = 40_000
MAX_TERMS = 2_000  # size of the model
MIN_DOCS, MIN_LOG_ODDS, MIN_EVIDENCE = 8, 1.5, 40.0
STEMS = range(3, 9)
DECIDE_AT = 0.3

# Letters of other scripts that look like Latin ones, and digits used for letters.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c",
    "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ӏ": "l",
})
DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})

_MIXED = re.compile(r"[a-z][013457@$]|[013457@$][a-z]")
_MIXED_WORD = re.compile(r"[a-z0-9@$]*(?:[a-z][013457@$]|[013457@$][a-z])[a-z0-9@$]*")
_WORD = re.compile(r"\w+")


def folded_words(text: str) -> list[str]:
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = text.lower().translate(HOMOGLYPHS)
    else:
        text = text.lower()
    if _MIXED.search(text):
        text = _MIXED_WORD.sub(lambda match: match[0].translate(DIGITS), text)
    return _WORD.findall(text)


@dataclass
class Model:
    """``terms``: ' word ' or ' beginning' with weights; ``excuses``: ' phrases ' around them."""

    terms: dict[str, float] = field(default_factory=dict)
    excuses: list[str] = field(default_factory=list)
    curve: list[float] = field(default_factory=lambda: [-20.0, 0.0, 0.0, 0.0])

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            # A folded "1" is an "i", but it may have stood for an "l".
            for form in {term, term.replace("l", "i")}:
                found.add_word(form, (len(form), weight))
        for phrase in self.excuses:
            found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found


def matches(automaton: ahocorasick.Automaton, words: list[str]) -> list[tuple[str, float]]:
    """The (term, weight) that counts at each place: the heaviest entry that no phrase excuses."""
    if not words or not len(automaton):
        return []
    line = f" {' '.join(words)} "
    best, excused = {}, []
    for end, (length, weight) in automaton.iter(line):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif start not in best or weight > best[start][1]:
            best[start] = (line[start:end + 1], weight)
    return [hit for start, hit in best.items()
            if not any(a <= start and start + len(hit[0]) - 1 <= b for a, b in excused)]


def features(hits: list[tuple[str, float]], n_words: int) -> list[float]:
    total = sum(weight for _, weight in hits)
    return [1.0, math.log1p(total), math.log1p(100 * total / (20 + n_words)),
            math.log1p(len({term for term, _ in hits}))]


# -- learning --------------------------------------------------------------------------------

def sample(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled rows that may be learnt from, stored."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .where(learns("doc_id", 4) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
             .distinct())
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    found = texts(documents).join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    for last in (False, True):  # two chances to meet
        found = _one_of_alike(found, last)
    return stored(found, "toxic")


def _one_of_alike(rows: DataFrame, last: bool) -> DataFrame:
    """One row of those with the same label and extreme hash of five-word runs.

    Copies of one text would else count as so much evidence for each of its words.
    """
    extreme = max if last else min

    def task(batches):
        for batch in small(batches):
            keys = []
            for text in batch.column(0).to_pylist():
                words = _WORD.findall(text)
                runs = (" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
                keys.append(extreme(crc32(run.encode()) for run in runs))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())],
                                             ["text", "toxic", "alike"])

    keyed = rows.mapInArrow(task, "text string, toxic int, alike bigint")
    return keyed.groupBy("alike", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _counted(rows: DataFrame, terms_of) -> DataFrame:
    """(term, n): in how many of the rows' texts a term occurs; ``terms_of(words)`` names them."""
    def task(batches):
        for batch in small(batches):
            found = Counter()
            for text in batch.column(0).to_pylist():
                found.update(terms_of(folded_words(text)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                ["term", "n"])
    return rows.select("text").mapInArrow(task, "term string, n bigint").groupBy("term").agg(
        F.sum("n").alias("n"))


def _forms(words: list[str]) -> set[str]:
    distinct = set(words)
    return {f" {word} " for word in distinct} | {
        f" {word[:size]}" for word in distinct for size in STEMS if len(word) > size}


def _evidence(a: int, b: int, toxic: int, clean: int) -> tuple[float, float]:
    """Log odds and likelihood ratio of a term in ``a`` of the toxic and ``b`` of the clean texts."""
    odds = math.log((a + .5) / (toxic + 1)) - math.log((b + .5) / (clean + 1))
    share, ratio = (a + b) / (toxic + clean), 0.0
    for seen, of in ((a, toxic), (b, clean)):
        for n, p in ((seen, share), (of - seen, 1 - share)):
            if n:
                ratio += 2 * n * math.log(n / (of * p))
    return odds, ratio


def _lexicon(rows: DataFrame, toxic: int, clean: int) -> dict[str, float]:
    bad = _counted(rows.where("toxic = 1"), _forms).where(F.col("n") >= MIN_DOCS)
    in_bad = dict(bad.collect())  # bounded by the sample
    in_clean = dict(_counted(rows.where("toxic = 0"), lambda words: _forms(words) & in_bad.keys())
                    .collect())
    weights = {}
    for term, a in in_bad.items():
        odds, ratio = _evidence(a, in_clean.get(term, 0), toxic, clean)
        if odds >= MIN_LOG_ODDS and ratio >= MIN_EVIDENCE:
            weights[term] = odds
    # A longer form that says no more than its beginning is left out.
    kept = {}
    for term in sorted(weights, key=len):
        body = term.strip()
        shorter = max((kept.get(f" {body[:size]}", 0.0) for size in range(1, len(body) + 1)
                       if f" {body[:size]}" != term), default=0.0)
        if weights[term] > shorter + .1:
            kept[term] = weights[term]
    # A beginning must say something beyond the longer forms that were kept.
    for term in sorted(kept, key=len, reverse=True):
        longer = [other for other in kept if other != term and other.startswith(term.rstrip())]
        a = max(0, in_bad[term] - sum(in_bad[other] for other in longer))
        b = max(0, in_clean.get(term, 0) - sum(in_clean.get(other, 0) for other in longer))
        odds, ratio = _evidence(min(a, toxic), min(b, clean), toxic, clean)
        if longer and (odds < MIN_LOG_ODDS or ratio < MIN_EVIDENCE):
            del kept[term]
    strongest = sorted(kept, key=lambda term: (-kept[term], term))[:MAX_TERMS]
    return {term: kept[term] for term in strongest}


def _excuses(rows: DataFrame, terms: dict[str, float]) -> list[str]:
    """Two-word phrases around a term that clean texts hold and toxic ones hardly do."""
    automaton = Model(terms).automaton()

    def phrases(words: list[str]) -> set[str]:
        if not matches(automaton, words):
            return set()
        return {f" {a} {b} " for a, b in zip(words, words[1:])
                if matches(automaton, [a]) or matches(automaton, [b])}

    clean = dict(_counted(rows.where("toxic = 0"), phrases).where("n >= 5").collect())
    if not clean:
        return []
    toxic = dict(_counted(rows.where("toxic = 1"), lambda words: phrases(words) & clean.keys()).collect())
    return sorted(phrase for phrase, n in clean.items() if 10 * toxic.get(phrase, 0) < n)  # as many as the sample holds


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton steps; the ridge keeps separable data finite."""
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return [float(v) for v in w]


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    known = sample(documents, labels, rows)
    n = dict(known.groupBy("toxic").count().collect())
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model(curve=[20.0 if toxic else -20.0, 0.0, 0.0, 0.0])
    terms = _lexicon(known, toxic, clean)
    model = Model(terms, _excuses(known, terms) if terms else [])

    def task(batches):
        automaton = model.automaton()
        for batch in small(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                words = folded_words(text)
                rows.append(features(matches(automaton, words), len(words)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    rows = known.mapInArrow(task, "x array<double>, toxic int").collect()  # bounded by the sample
    model.curve = _fit(np.array([row.x for row in rows]), np.array([row.toxic for row in rows], float))
    return model


# -- scoring ---------------------------------------------------------------------------------

def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, score, n_words, n_hits) of each row, by its text alone."""
    rows = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    curve = model.curve

    def task(batches):
        automaton = model.automaton()
        for batch in small(batches):
            scores, sizes, counts = [], [], []
            for text in batch.column("text").to_pylist():
                words = folded_words(text)
                hits = matches(automaton, words)
                z = sum(a * b for a, b in zip(curve, features(hits, len(words))))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                sizes.append(len(words))
                counts.append(len(hits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(scores, pa.float64()),
                 pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "text_key", "score", "n_words", "n_hits"])

    return rows.mapInArrow(task, T.StructType([
        T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("text_key", T.LongType()),
        T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType()),
        T.StructField("n_hits", T.LongType())]))


def predicted(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", (~learns("doc_id", 4)).alias("held_out"), "score",
                         (F.col("score") >= DECIDE_AT).cast("int").alias("predicted"), "n_words", "n_hits")
