"""Byte-level BPE: every distinct word is encoded once, wherever it stands.

1. Tasks cut texts into words by the vocabulary's pattern and take documents together as blocks.
   A block numbers its words; documents become sequences of numbers, which keep the positions.
2. Each block's distinct words are dealt by their hash: equal words of all blocks meet in one task,
   which merges each of them once and sends the ids back to the blocks that asked.
3. Blocks put the ids in place of the numbers.
Words travel once for each block, not for each occurrence, so a frequent word makes as many rows as
there are blocks and no task gets more of it. Sequences travel once, as compressed bytes.

Blocks are cut twice, for words and for sequences, in the same way from the same input splits; a
check sum of their words fails the job if the input changed in between.

Defined cases: null or empty text has no ids; repeated rows are encoded each; a null ``doc_id`` stays
null; only ``doc_id`` and ``text`` are read. Decoding an id that the table lacks fails.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.llm.rows import texts

BLOCK_CHARS = 4_000_000
PARTS_PER_TASK = 2
_EXCHANGE = "block bigint, part int, check_sum bigint, numbers binary, content binary"
_END = b"\xff"  # occurs in no UTF-8 text


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the adjacent pair of lowest rank is joined, leftmost first, while there is one."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    ends, before, gone = list(range(1, n + 1)), list(range(-1, n)), bytearray(n)
    waiting = [(rank, i, i + 2) for i in range(n - 1)
               if (rank := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, left, end = heapq.heappop(waiting)
        right = ends[left]
        if gone[left] or right >= n or ends[right] != end:
            continue  # one of the two has grown since
        gone[right], ends[left] = 1, end
        if end < n:
            before[end] = left
            if (rank := ranks.get(word[left:ends[end]])) is not None:
                heapq.heappush(waiting, (rank, left, ends[end]))
        if left and (rank := ranks.get(word[before[left]:end])) is not None:
            heapq.heappush(waiting, (rank, before[left], end))
    found, at = [], 0
    while at < n:
        found.append(ranks[word[at:ends[at]]])
        at = ends[at]
    return found


def _pack(array: np.ndarray) -> bytes:
    """Byte planes compress better than whole numbers, as high bytes are mostly equal."""
    planes = array.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str):
    """Yields (block id, doc_ids, words of each, numbers in order, words by number)."""
    cut = regex.compile(pattern).findall
    task, made = TaskContext.get().partitionId(), count()

    def close():
        seen = np.concatenate(sequences) if sequences else np.empty(0, np.uint32)
        by_use = np.argsort(-np.bincount(seen, minlength=len(numbers)), kind="stable")
        renamed = np.empty(len(numbers), np.uint32)
        renamed[by_use] = np.arange(len(numbers), dtype=np.uint32)
        listed = list(numbers)
        return ((task << 32) + next(made), pa.array(ids, id_type), lengths, renamed[seen],
                [listed[i].encode() for i in by_use])

    def empty():
        return [], [], [], defaultdict(count().__next__), 0

    ids, lengths, sequences, numbers, chars = empty()
    id_type = pa.null()
    for batch in batches:
        id_type = batch.column(0).type
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = cut(text.as_py())
            ids.append(doc_id)
            lengths.append(len(found))
            sequences.append(np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found)))
            chars += len(text.as_buffer())
            if chars >= BLOCK_CHARS:
                yield close()
                ids, lengths, sequences, numbers, chars = empty()
    if ids:
        yield close()


def _check_sum(words: list[bytes]) -> int:
    return zlib.crc32(_END.join(words))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    names = ["block", "part", "check_sum", "numbers", "content"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _sequences(pattern: str):
    def task(batches):
        for block, ids, lengths, numbers, words in _blocks(batches, pattern):
            sink = pa.BufferOutputStream()
            docs = pa.RecordBatch.from_arrays([ids, pa.array(lengths, pa.int64())], ["doc_id", "n"])
            with pa.ipc.new_stream(sink, docs.schema) as stream:
                stream.write_batch(docs)
            yield _batch([(block, -1, _check_sum(words), _pack(numbers),
                           zstandard.compress(sink.getvalue().to_pybytes(), 1))])
    return task


def _word_lists(pattern: str, parts: int):
    def task(batches):
        for block, _, _, _, words in _blocks(batches, pattern):
            total = _check_sum(words)
            part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % parts
            order = np.argsort(part, kind="stable")
            rows = []
            for numbers in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                if len(numbers):
                    listed = _END.join([words[i] for i in numbers])
                    rows.append((block, int(part[numbers[0]]), total,
                                 _pack(np.diff(numbers, prepend=0)), zstandard.compress(listed, 1)))
            if rows:
                yield _batch(rows)
    return task


def _encoder(shared):
    """Merges the words dealt to this task, each distinct one once."""
    def task(batches):
        ranks, known = shared.value, {}
        for batch in batches:
            rows = []
            for block, part, total, numbers, content in zip(*(c.to_pylist() for c in batch.columns)):
                found = []
                for word in zstandard.decompress(content).split(_END):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(merge(word, ranks), np.uint32)
                    found.append(ids)
                sizes = np.fromiter(map(len, found), np.uint32, len(found))
                both = np.concatenate([np.array([len(found)], np.uint32), sizes, *found])
                rows.append((block, part, total, numbers, _pack(both)))
            yield _batch(rows)
    return task


def _assemble(group: pa.Table) -> pa.Table:
    """One block: the ids of its words in the places of their numbers."""
    rows = group.to_pylist()
    own = [row for row in rows if row["part"] < 0]
    if len(own) != 1 or any(row["check_sum"] != own[0]["check_sum"] for row in rows):
        raise ValueError("documents changed while they were encoded")
    docs = pa.ipc.open_stream(zstandard.decompress(own[0]["content"])).read_all()
    places, sizes, pieces = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
    for row in rows:
        if row["part"] >= 0:
            both = _unpack(row["content"])
            places.append(np.cumsum(_unpack(row["numbers"]), dtype=np.uint32))
            sizes.append(both[1:both[0] + 1])
            pieces.append(both[both[0] + 1:])
    places, sizes, pieces = map(np.concatenate, (places, sizes, pieces))
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    size, start = np.empty(len(places), np.int64), np.empty(len(places), np.int64)
    size[places], start[places] = sizes, starts
    numbers = _unpack(own[0]["numbers"])
    lengths = size[numbers]
    ends = np.cumsum(lengths)
    ids = pieces[np.repeat(start[numbers] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(docs["n"].to_numpy())]).astype(np.int64)]
    raw = ids.astype("<u4").tobytes()
    return pa.table({"doc_id": docs["doc_id"], "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                     "ids": pa.array([raw[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])], pa.binary())})


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) for each document row; ``ids`` as little-endian 32-bit integers.

    ``ranks`` is bounded by the vocabulary, so every executor gets all of it.
    """
    spark = documents.sparkSession
    rows = texts(documents)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(ranks)
    lists = rows.mapInArrow(_word_lists(pattern, PARTS_PER_TASK * tasks), _EXCHANGE)
    encoded = lists.repartition(tasks, "part").mapInArrow(_encoder(shared), _EXCHANGE)
    sequences = rows.mapInArrow(_sequences(pattern), _EXCHANGE)
    out = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType),
                        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return sequences.unionByName(encoded).groupBy("block").applyInArrow(_assemble, out)


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds ``decoded``, the bytes that ``ids`` stand for, by joining the table of token bytes.

    The table is bounded by the vocabulary and joined as an array, the id being its index.
    """
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def task(batches):
        tokens = shared.value
        for batch in batches:
            column = batch.column("ids").to_pylist()
            decoded = [None if ids is None else
                       b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])
                       for ids in column]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    kept = encoded.drop("decoded")
    return kept.mapInArrow(task, T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
