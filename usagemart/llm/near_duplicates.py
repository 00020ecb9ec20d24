"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's shingles, five words in a row each, weigh their count times an inverse document frequency.
Each sample picks one shingle of a text and a quantum of its weight, such that two texts pick the
same with the probability of their weighted Jaccard similarity. Samples are banded; texts that meet
in a band's bucket are compared in full, and those with a weighted Jaccard similarity of
``THRESHOLD`` or more are linked. Classes are the connected components.

Document frequencies are counted over all documents in ``2 ** IDF_BITS`` hashed bins, so their table
has a fixed size; a bin also counts the few other shingles that fall into it, which matters little
as rarer shingles than one in ``RAREST`` documents all weigh the same.

Exact copies are one text from the start. In a bucket, members are compared with leaders: first with the
one that shares most buckets with others (the middle of its group), then, in buckets whose members are not
yet in one class, with some members of all classes but the largest. Buckets that are still mixed, as those of
texts that share a passage but are not alike, are split by further samples, in several ways, so that unlike
members part, a pair at the threshold still meets somewhere, and each of the parts gets leaders of its own. Up to
there work is linear in the members of each level. What is mixed after the last level has more and more leaders
until no two members of different classes are left uncompared.
Pairs whose samples agree too rarely for the threshold are not compared in full.

What only texts of its class have, among all that are still in buckets, is a text's own weight. It bounds its similarity
with texts of other classes: of a pair, the rest of the lighter may be in common, and both own weights are in the union.
Texts, members and pairs whose bound is below the threshold are left out, which loses nothing; texts around a common
passage go this way. As classes grow and buckets empty, own weights are summed again.
Sketches, the weights of a text in hashed bins of shingles, bound what a pair may have in common: edited copies of one text
that differ in too many places go this way, which loses nothing either, before the pair is made: members of a bucket meet its
leaders in a sorted stream, those of a large bucket in chunks, and only pairs that may be near become rows.

Defined cases: null text is empty; texts without words are nobody's duplicate; shorter texts than a
shingle have one shingle of all their words; repeated rows are copies; a class is named after its
least ``doc_id`` (null if it has none). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from usagemart.llm.components import components
from usagemart.llm.rows import SPACE, let_go, small, stored
from usagemart.session import scratch_scope

WORDS, THRESHOLD = 5, 0.8
# Bands are subsets of the samples, so that few samples make many bands. Of pairs whose samples agree
# independently, 0.1 % meet in no bucket at the threshold and 0.01 % at 0.85.
SAMPLES, BANDS, ROWS = 32, 24, 4
# A mixed bucket is split LEVELS times, by STEP samples a time, in WAYS ways. Of pairs at the threshold that no leader
# has compared, about 0.6, 1.8 and 4.2 % are parted by the first to the third split.
STEP, WAYS, LEVELS = 2, 2, 3
LEADERS = 32  # of a bucket at a time
CHUNK = 2_000  # members of a bucket who meet its leaders in one task
MET = 10_000  # pairs of a member and a leader looked at together
# Of pairs at the threshold, 1 of 10,000 agrees in fewer of the 32 samples.
LEAST_AGREED = 16
SKETCH_BINS = 256  # of shingles; two bytes each
BROADCAST_KEYS = 500_000  # of 16 bytes; more are joined by a shuffle
IDF_BITS, RAREST = 18, 10
TABLE_BITS, SEED = 16, 20_240_131
_PARTS = 32

_MIX = np.uint64(0x9E3779B97F4A7C15)


def text_key() -> Column:
    """Names a text; 128 bits, so that different texts of a large corpus do not meet by chance."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _hashes() -> Column:
    listed = F.array_remove(F.split(F.lower("text"), SPACE), "")
    return F.transform(listed, lambda word: F.xxhash64(word))


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) of word hashes with their counts, ordered by row and shingle."""
    offsets = column.offsets.to_numpy()
    words = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].view(np.uint64)
    starts, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), counts)
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(len(row))
    length = np.repeat(np.minimum(sizes, WORDS), counts)
    value = np.zeros(len(row), np.uint64)
    for i in range(WORDS):
        there = i < length
        at = np.minimum(first + i, max(len(words) - 1, 0))
        value = np.where(there, _mixed(value + _MIX + (words[at] if len(words) else 0)), value)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return row[at], value[at], np.diff(np.append(at, len(row)))


def _bin(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - IDF_BITS)).astype(np.int64)


def inverse_frequencies(documents: DataFrame) -> np.ndarray:
    """1 + log10 of how many documents there are for one with the shingle, for each hashed bin.

    Partial counts travel as compressed slices of the table; what reaches the driver has a fixed size.
    """
    def count(batches):
        seen, docs = np.zeros(1 << IDF_BITS, np.int64), 0
        for piece in small(batches):
            row, value, _ = shingles(piece.column(0))
            pairs = np.unique(row.astype(np.int64) << IDF_BITS | _bin(value))
            seen += np.bincount(pairs & ((1 << IDF_BITS) - 1), minlength=1 << IDF_BITS)
            docs += len(piece)
        slices = [zstandard.compress(part.tobytes(), 1) for part in np.split(seen, _PARTS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(_PARTS), -1], pa.int32()),
             pa.array([*slices, zstandard.compress(np.array([docs]).tobytes())], pa.binary())],
            ["part", "counts"])

    def add(batches):
        totals = {}
        for batch in batches:
            for part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                totals[part] = totals.get(part, 0) + np.frombuffer(zstandard.decompress(counts), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()),
             pa.array([zstandard.compress(c.tobytes(), 1) for c in totals.values()], pa.binary())],
            ["part", "counts"])

    kind = "part int, counts binary"
    partial = _rows(documents).select(_hashes().alias("words")).mapInArrow(count, kind)
    # Two steps: each slice is first added up by many tasks, then by one.
    salted = partial.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(64)))
    added = salted.repartition("part", "salt").drop("salt").mapInArrow(add, kind)
    total = {part: np.frombuffer(zstandard.decompress(counts), np.int64)
             for part, counts in added.repartition("part").mapInArrow(add, kind).collect()}
    docs = total.get(-1, np.zeros(1))[0]
    if not docs:
        return np.ones(1 << IDF_BITS, np.float32)
    seen = np.concatenate([total[part] for part in range(_PARTS)])
    return (1 + np.log10(np.minimum(docs / np.maximum(seen, 1), RAREST))).astype(np.float32)


def _tables(top: float) -> list[tuple]:
    """For each sample: a multiplier that picks an entry by shingle, tables of r, beta and ln c, and what
    they give for the weight ``top``, which most shingles have."""
    dice = np.random.default_rng(SEED)
    made = []
    for _ in range(SAMPLES):
        size = 1 << TABLE_BITS
        odd = np.uint32(int(dice.integers(1 << 31)) * 2 + 1)
        r = dice.gamma(2.0, size=size).astype(np.float32)
        beta = dice.random(size).astype(np.float32)
        log_c = np.log(dice.gamma(2.0, size=size)).astype(np.float32)
        made.append((odd, r, beta, log_c, _drawn(np.float32(np.log(top)), r, beta, log_c)[1]))
    return made


def _bands() -> np.ndarray:
    dice = np.random.default_rng(SEED + 1)
    return np.array([np.sort(dice.choice(SAMPLES, ROWS, replace=False)) for _ in range(BANDS)])


def _drawn(log_w, r: np.ndarray, beta: np.ndarray, log_c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """t = floor(ln w / r + beta) and ln a = ln c - r (t - beta) - r."""
    t = np.floor(log_w / r + beta)
    return t, log_c - r * (t - beta + 1)


def samples(row: np.ndarray, value: np.ndarray, weight: np.ndarray, tables, top: float) -> np.ndarray:
    """Consistent weighted samples: a row for each row with shingles, a hash for each table.

    The shingle of least a and its t are the sample. Equal a's go to the least shingle, being first.
    """
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(row)])
    weight = weight.astype(np.float32)
    log_w, other = np.log(weight), np.flatnonzero(weight != np.float32(top))
    low = value.astype(np.uint32)
    out = np.empty((len(starts), len(tables)), np.uint64)
    if not len(starts):
        return out
    for k, (odd, r, beta, log_c, at_top) in enumerate(tables):
        at = (low * odd) >> np.uint32(32 - TABLE_BITS)
        a = at_top[at]
        if len(other):
            entry = at[other]
            a[other] = _drawn(log_w[other], r[entry], beta[entry], log_c[entry])[1]
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, sizes))
        hit = hit[np.searchsorted(hit, starts)]
        entry = at[hit]
        t = _drawn(log_w[hit], r[entry], beta[entry], log_c[entry])[0]
        out[:, k] = _mixed(value[hit] ^ (t.astype(np.int64).view(np.uint64) * _MIX))
    return out


def _levels() -> list[np.ndarray]:
    """For each level of splits, the samples that split it: an array by path and way. A path is a band and the
    ways taken since; no sample comes twice in it."""
    dice, used = np.random.default_rng(SEED + 2), [set(band.tolist()) for band in _bands()]
    levels = []
    for _ in range(LEVELS):
        split = np.array([dice.permutation(sorted(set(range(SAMPLES)) - taken))[:WAYS * STEP].reshape(WAYS, STEP)
                          for taken in used])
        used = [taken | set(split[path, way].tolist()) for path, taken in enumerate(used) for way in range(WAYS)]
        levels.append(split)
    return levels


def _hashed(node: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """``node`` with the picked samples, whose last dimension is gone through, mixed in."""
    for i in range(picked.shape[-1]):
        node = _mixed(node * _MIX + _MIX + picked[..., i])
    return node


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(column), -1)


def signed(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, key, samples) of every row; ``samples`` is null for a text without words."""
    rows = _rows(documents).select("doc_id", text_key().alias("key"), _hashes().alias("words"))
    shared = documents.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def task(batches):
        top = float(shared.value.max())
        tables = _tables(top)
        for piece in small(batches):
            row, value, count = shingles(piece.column("words"))
            found = samples(row, value, count * shared.value[_bin(value)], tables, top)
            listed = [None] * len(piece)
            for at, one in zip(np.unique(row).tolist(), found.view(np.int64).tolist()):
                listed[at] = one
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("key"), pa.array(listed, pa.list_(pa.int64()))],
                ["doc_id", "key", "samples"])

    return rows.mapInArrow(task, T.StructType([
        rows.schema["doc_id"], T.StructField("key", T.BinaryType()),
        T.StructField("samples", T.ArrayType(T.LongType()))]))


def _members(rows: DataFrame, split: np.ndarray | None = None) -> DataFrame:
    """(bucket, path, key): the bands of texts with their samples, or, of members of buckets, the parts at the next level."""
    bands = _bands() if split is None else None

    def task(batches):
        for piece in small(batches):
            found = _matrix(piece.column("samples"))
            if split is None:
                picked, path = found[:, bands], np.broadcast_to(np.arange(BANDS), (len(found), BANDS))
                node = path.astype(np.uint64)
            else:
                before = piece.column("path").to_numpy(zero_copy_only=False)
                picked = found[np.arange(len(found))[:, None, None], split[before]]
                path = before[:, None] * split.shape[1] + np.arange(split.shape[1])
                bucket = piece.column("bucket").to_numpy(zero_copy_only=False).view(np.uint64)
                node = _mixed(bucket[:, None] + np.arange(split.shape[1], dtype=np.uint64))
            node = _hashed(node, picked)
            of = pa.array(np.repeat(np.arange(len(found)), node.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node.ravel().view(np.int64)), pa.array(path.ravel(), pa.int32()), piece.column("key").take(of)],
                ["bucket", "path", "key"])

    wanted = ["key", "samples"] if split is None else ["bucket", "path", "key", "samples"]
    return rows.select(*wanted).mapInArrow(task, "bucket bigint, path int, key binary")


def _buckets(distinct: DataFrame) -> DataFrame:
    """(bucket, path, key, shared) of texts that are not alone in a bucket, stored; a bucket's hash holds its band.

    ``shared``: how many others a text meets over all bands; the text in the middle of a group most.
    """
    places = _members(distinct.where("samples IS NOT NULL"))
    sizes = places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    met = stored(places.join(sizes, "bucket"), "met")
    shared = met.groupBy("key").agg(F.sum("size").alias("shared"))
    return stored(met.drop("size").join(shared, "key"), "buckets")


def _may_be_near(rest: Column | np.ndarray, own: Column | np.ndarray) -> Column | np.ndarray:
    """Whether rest / (rest + own) reaches the threshold, but for rounding."""
    return rest * (1 - THRESHOLD) >= own * THRESHOLD - 1e-6 * rest


def _open(members: DataFrame) -> DataFrame:
    """``members`` who may be near somebody of another class in their bucket, by the least own weight among those."""
    of_class = members.groupBy("bucket", "root").agg(F.min("own").alias("own"))
    first = of_class.groupBy("bucket").agg(F.min(F.struct("own", "root")).alias("first"))
    second = of_class.join(first, "bucket").where(F.col("root") != F.col("first.root")).groupBy("bucket").agg(
        F.min("own").alias("second"), F.first("first").alias("first"))
    other = F.when(F.col("root") == F.col("first.root"), F.col("second")).otherwise(F.col("first.own"))
    return members.join(second, "bucket").where(_may_be_near(F.col("rest"), F.col("own") + other)).drop("first", "second")


def _leaders(members: DataFrame, turn: int) -> DataFrame:
    """(bucket, leader, leader_root, leader_own, leader_rest, size of the bucket): in the first turn the member of each bucket that shares most, later ``LEADERS``
    members of all classes but the bucket's largest, and four times as many in each turn after the last split.
    Those with the least weight of their own come first: they are near most others, and in many of their buckets."""
    led = {"key": "leader", "root": "leader_root", "own": "leader_own", "rest": "leader_rest"}
    if turn == 0:
        best = F.min(F.struct((-F.col("shared")).alias("rank"), *led)).alias("l")
        return members.groupBy("bucket").agg(best, F.count("*").alias("size")).select("bucket", "l.*", "size").drop(
            "rank").withColumnsRenamed(led)
    largest = members.groupBy("bucket", "root").count().groupBy("bucket").agg(
        F.max(F.struct("count", "root")).alias("m"), F.sum("count").alias("size")).select(
        "bucket", F.col("m.root").alias("largest"), "size")
    order = Window.partitionBy("bucket").orderBy("own", F.xxhash64("key", F.lit(turn)), "key")
    found = members.join(largest, "bucket").where("root != largest").withColumn("place", F.row_number().over(order))
    most = LEADERS * 4 ** min(max(turn - LEVELS - 1, 0), 20)
    return found.where(F.col("place") <= most).select("bucket", *led, "size").withColumnsRenamed(led)


def _candidates(members: DataFrame, leaders: DataFrame, distinct: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b): the leaders and the members of other classes in their buckets who may be near by own weights and sketches,
    and whose samples agree often enough. Only pairs that may be near become rows."""
    def rows(side: DataFrame, chunk: Column, leads: bool) -> DataFrame:
        return side.join(sketches, "key").select(
            "bucket", chunk.alias("chunk"), F.lit(leads).alias("leads"), "key",
            F.xxhash64("root").alias("root"), "own", "rest", "sketch", "total")

    # Members of a large bucket are dealt to several chunks, and its leaders go to each of them.
    chunks = F.floor(F.col("size") / CHUNK).cast("int")
    large = leaders.where(F.col("size") >= CHUNK).select("bucket", (chunks + 1).alias("chunks")).distinct()
    led = leaders.withColumnsRenamed({f"leader_{name}": name for name in ("root", "own", "rest")} | {"leader": "key"})
    dealt = rows(members.join(large, "bucket", "left"), F.coalesce(F.pmod(F.hash("key"), "chunks"), F.lit(0)), False)
    met = rows(led, F.explode(F.sequence(F.lit(0), chunks)), True).unionByName(dealt).repartition(
        "bucket", "chunk").sortWithinPartitions("bucket", "chunk", F.desc("leads"))
    pairs = met.mapInArrow(lambda batches: _near_by_sketch(_led(batches)), "a binary, b binary").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = distinct.select(F.col("key").alias("a"), F.col("samples").alias("samples_a"))
    two = distinct.select(F.col("key").alias("b"), F.col("samples").alias("samples_b"))
    same = F.filter(F.zip_with("samples_a", "samples_b", lambda x, y: x == y), lambda agree: agree)
    return pairs.join(one, "a").join(two, "b").where(F.size(same) >= LEAST_AGREED).select("a", "b")


def _led(batches):
    """(a, b, sketch, leader_sketch, total): members and leaders of chunks, of which leaders come first, who may be near."""
    before = []  # leaders of the chunk that the last batch ended in
    for batch in small(batches, 5_000):
        piece = pa.Table.from_batches([*before, batch]).combine_chunks().to_batches()[0]
        bucket, chunk, leads, root, own, rest, total = (
            piece.column(name).to_numpy(zero_copy_only=False)
            for name in ("bucket", "chunk", "leads", "root", "own", "rest", "total"))
        start = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (chunk[1:] != chunk[:-1])])
        n_leaders, sizes = np.add.reduceat(leads.astype(np.int64), start), np.diff(np.r_[start, len(piece)])
        member, first = np.flatnonzero(~leads), np.repeat(start, sizes)
        n = np.repeat(n_leaders, sizes)[member]
        before = [piece.slice(start[-1], n_leaders[-1])]
        ends = np.cumsum(n)
        for at in range(0, int(n.sum()), MET):
            # A slice of the pairs of all members and leaders.
            pair = np.arange(at, min(at + MET, ends[-1]))
            of = np.searchsorted(ends, pair, "right")
            who, leader = member[of], first[member[of]] + pair - (ends - n)[of]
            near = (root[who] != root[leader]) & _may_be_near(np.minimum(rest[who], rest[leader]), own[who] + own[leader])
            who, leader = who[near], leader[near]
            one, two = (piece.select(["key", "sketch"]).take(pa.array(side)) for side in (who, leader))
            yield pa.RecordBatch.from_arrays([one.column(0), two.column(0), one.column(1), two.column(1),
                                              pa.array(total[who] + total[leader])],
                                             ["a", "b", "sketch", "leader_sketch", "total"])


def _near_by_sketch(batches):
    """(a, b) of the pairs whose sketches allow a similarity at the threshold."""
    for piece in small(batches, 2_000):
        # Positive half floats are in the order of their bits.
        least = np.minimum(*(np.frombuffer(b"".join(piece.column(name).to_pylist()), np.uint16).reshape(len(piece), SKETCH_BINS)
                             for name in ("sketch", "leader_sketch"))).view(np.float16)
        both = least.astype(np.float64).sum(axis=1)
        far = both < (piece.column("total").to_numpy() - both) * (THRESHOLD - 1e-6)
        yield piece.select(["a", "b"]).filter(pa.array(~far))


def sketched(known: DataFrame) -> DataFrame:
    """(key, sketch, total) of ``weighted`` texts: the weight of their shingles in each of ``SKETCH_BINS`` hashed bins, as
    half floats that are never too small. The lesser weights of two texts, bin by bin, add up to what they share or more."""
    def task(batches):
        for piece in small(batches):
            listed = piece.column("shingles")
            row = np.repeat(np.arange(len(piece)), np.diff(listed.offsets.to_numpy()))
            at = (_mixed(listed.flatten().to_numpy().view(np.uint64)) % np.uint64(SKETCH_BINS)).astype(np.int64)
            weight = piece.column("weights").flatten().to_numpy()
            bins = np.bincount(row * SKETCH_BINS + at, weight, len(piece) * SKETCH_BINS).reshape(len(piece), SKETCH_BINS)
            with np.errstate(over="ignore"):  # infinity rules nothing out
                halves = (bins * 1.001).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), pa.array([half.tobytes() for half in halves], pa.binary()),
                 pa.array(bins.sum(axis=1))], ["key", "sketch", "total"])

    return known.mapInArrow(task, "key binary, sketch binary, total double")


def weighted(texts: DataFrame, weights: np.ndarray) -> DataFrame:
    """(key, shingles, weights) of each (key, words); the shingles in order."""
    shared = texts.sparkSession.sparkContext.broadcast(weights)  # of fixed size

    def task(batches):
        for piece in small(batches):
            row, value, count = shingles(piece.column("words"))
            bounds = pa.array(np.searchsorted(row, np.arange(len(piece) + 1)), pa.int32())
            weight = count * shared.value[_bin(value)].astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), pa.ListArray.from_arrays(bounds, pa.array(value.view(np.int64))),
                 pa.ListArray.from_arrays(bounds, pa.array(weight))], ["key", "shingles", "weights"])

    return texts.mapInArrow(task, "key binary, shingles array<bigint>, weights array<double>")


def own_weights(known: DataFrame) -> DataFrame:
    """(key, own, rest) of ``weighted`` texts with the ``root`` of their class: the weight of the shingles that no text
    of another class has, and of the others. Texts that may be near none are left out."""
    def task(batches):
        for piece in small(batches):
            listed = piece.column("shingles")
            times = np.diff(listed.offsets.to_numpy())
            text, root = (pa.array(np.repeat(piece.column(name).to_numpy(), times)) for name in ("text", "class"))
            yield pa.RecordBatch.from_arrays([text, root, listed.flatten(), piece.column("weights").flatten()],
                                             ["text", "class", "shingle", "weight"])

    named = known.withColumns({"text": F.xxhash64("key"), "class": F.xxhash64("root")})
    single = named.select("text", "class", "shingles", "weights").mapInArrow(
        task, "text bigint, class bigint, shingle bigint, weight double").repartition("shingle")  # once for both uses
    common = single.groupBy("shingle").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi")
    rest = single.join(common.select("shingle"), "shingle").groupBy("text").agg(F.sum("weight").alias("rest"))
    total = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    return named.select("key", "text", total.alias("total")).join(rest, "text").select(
        "key", F.greatest(F.col("total") - F.col("rest"), F.lit(0.0)).alias("own"), "rest").where(
        _may_be_near(F.col("rest"), F.col("own")))


def similarities(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b, similarity): the weighted Jaccard similarity of each pair, from the ``weighted`` texts."""
    def task(batches):
        for batch in small(batches, 200):
            row, value, weight = [], [], []
            for side in "ab":
                listed = batch.column(f"shingles_{side}")
                row.append(np.repeat(np.arange(len(batch)), np.diff(listed.offsets.to_numpy())))
                value.append(listed.flatten().to_numpy(zero_copy_only=False))
                weight.append(batch.column(f"weights_{side}").flatten().to_numpy(zero_copy_only=False))
            row, value, weight = map(np.concatenate, (row, value, weight))
            order = np.lexsort((value, row))
            row, value, weight = row[order], value[order], weight[order]
            twin = np.flatnonzero((row[1:] == row[:-1]) & (value[1:] == value[:-1]))
            both = np.bincount(row[twin], np.minimum(weight[twin], weight[twin + 1]), len(batch))
            either = np.bincount(row, weight, len(batch)) - both
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"),
                 pa.array(np.divide(both, either, out=np.zeros(len(batch)), where=either > 0))],
                ["a", "b", "similarity"])

    def side(name: str) -> DataFrame:
        return known.select(F.col("key").alias(name), F.col("shingles").alias(f"shingles_{name}"),
                            F.col("weights").alias(f"weights_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
        task, "a binary, b binary, similarity double")


def links(documents: DataFrame, distinct: DataFrame, weights: np.ndarray) -> DataFrame | None:
    """(node, root) of the texts that have a near duplicate; None if there are none."""
    buckets = _buckets(distinct)
    keys = stored(buckets.select("key").distinct(), "keys")
    wanted = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    texts = _rows(documents).select(text_key().alias("key"), "text").join(wanted, "key", "left_semi").groupBy(
        "key").agg(F.min("text").alias("text")).select("key", _hashes().alias("words"))
    known = stored(weighted(texts, weights), "weighted")
    let_go(documents.sparkSession)
    sketches = stored(sketched(known), "sketches")
    distinct = stored(distinct.join(wanted, "key", "left_semi").select("key", "samples"), "samples")

    def weighed(members: DataFrame, roots: DataFrame | None, split: np.ndarray | None = None) -> DataFrame:
        """``members`` (bucket, path, key, ...), or the parts they are split into, with their classes and own weights,
        without those who can be near nobody."""
        rooted = _rooted(known.join(members.select("key").distinct(), "key", "left_semi"), roots)
        weight = stored(own_weights(rooted), "own")
        let_go(documents.sparkSession)
        if split is not None:
            members = _members(members.join(weight.select("key"), "key", "left_semi").join(distinct, "key"), split)
        return stored(_open(_rooted(members.join(weight, "key"), roots)), "members")

    members, roots, levels = weighed(buckets, None), None, _levels()
    for turn in count():
        if members.isEmpty():
            return roots
        leaders = stored(_leaders(members, turn), "leaders")
        pairs = stored(_candidates(members, leaders, distinct, sketches), "pairs")
        linked = stored(similarities(pairs, known).where(F.col("similarity") >= THRESHOLD).select("a", "b"), "linked")
        if not linked.isEmpty():
            # Classes so far stand for the links that made them.
            found = linked if roots is None else linked.unionByName(roots.selectExpr("node AS a", "root AS b"))
            roots = stored(components(found), "roots")
        # Who has led a bucket has met all of its members.
        left = members.drop("root", "own", "rest").join(
            leaders.select("bucket", F.col("leader").alias("key")), ["bucket", "key"], "left_anti")
        # Two turns before anything is split.
        members = weighed(left, roots, levels[turn - 1] if 1 <= turn <= LEVELS else None)


def _rooted(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``members`` with the ``root`` of their class, by default themselves."""
    if roots is None:
        return members.withColumn("root", F.col("key"))
    return members.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key"))


def classes(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, class_id, first, has_words) of every row, stored.

    ``first``: the row names its class; repeated rows of that id and text all do.
    """
    with scratch_scope(documents.sparkSession) as keep:
        return keep(_classes(documents), "classes")


def _classes(documents: DataFrame) -> DataFrame:
    weights = inverse_frequencies(documents)
    rows = stored(signed(documents, weights), "signed")
    distinct = stored(rows.groupBy("key").agg(F.min("doc_id").alias("least_id"),
                                              F.first("samples").alias("samples")), "distinct")
    roots = links(documents, distinct, weights)
    named = distinct.where("samples IS NOT NULL").select("key", "least_id")
    if roots is None:
        of_text = named.withColumns({"class_id": F.col("least_id"), "class_key": F.col("key")})
    else:
        rooted = named.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
            "root", F.coalesce("root", "key"))
        least = rooted.groupBy("root").agg(
            F.min(F.struct(F.col("least_id").isNull(), "least_id", "key")).alias("m"))
        of_text = rooted.join(least.select("root", F.col("m.least_id").alias("class_id"),
                                           F.col("m.key").alias("class_key")), "root")
    of_text = of_text.select("key", "class_id", "class_key")
    return rows.select("doc_id", "key", F.col("samples").isNull().alias("wordless")).join(of_text, "key", "left").select(
        "doc_id", F.col("key").alias("text_key"),
        F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("wordless") | (F.col("doc_id").eqNullSafe(F.col("class_id"))
                                    & (F.col("key") == F.col("class_key")))).alias("first"),
        (~F.col("wordless")).alias("has_words"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` with all of their columns, but one row of each class; wordless rows all stay."""
    rows = classes(documents)

    def only(docs: DataFrame, named: DataFrame, how: str) -> DataFrame:
        named = named.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
        key = F.unhex(F.md5(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")))
        return docs.join(named, docs["doc_id"].eqNullSafe(named["_id"]) & (key == named["_key"]), how)

    kept = only(documents, rows.where("NOT first"), "left_anti")
    repeated = stored(rows.where("first AND has_words").groupBy("doc_id", "text_key").count()
                      .where("count > 1"), "repeated")
    if repeated.isEmpty():
        return kept
    once = only(kept, repeated, "left_semi").dropDuplicates(["doc_id", "text"])
    return only(kept, repeated, "left_anti").unionByName(once)
