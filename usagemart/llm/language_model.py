"""Language-model scores by a hierarchical Pitman-Yor model with Chinese-restaurant seating.

Each word that occurs before others is a restaurant (one more serves the first words of texts), whose dishes are the
words that follow it. All of them share a parent, the root, whose base is uniform over the vocabulary and one unknown
word: a customer who opens a table in a restaurant is a customer of the root. A sweep of Gibbs moves takes every
customer, in restaurants and at the root, from their seat and seats them anew given all others; the predictive probabilities are averaged over the last
``KEPT`` of ``SWEEPS`` sweeps.

1. Blocks of documents list their distinct words, dealt by word, and their distinct pairs with training counts,
   dealt by the word before, so that a restaurant lies in one part. A frequent pair is a row of a block, not of
   each occurrence. Restaurants that hold more than one of ``HOT`` customers (there are fewer than ``HOT``) are dealt by
   pair instead; only the numbers of their tables are added up between sweeps.
2. A part's dishes with one customer have one table whatever happens; the others keep the sizes of their tables.
   A sweep reads them with the root's probabilities of their words, moves every customer of each dish and writes
   them back with the change in the number of tables by word. Dishes of a part move at once, given the round before.
   Customers of a dish with more than ``ROUNDS`` move in ``ROUNDS`` groups, so that no dish takes longer than its size.
3. The root takes in the changes by word, moves all its customers, and answers the parts with probabilities.
4. Parts send the blocks what they need for the probabilities of their pairs, which blocks add up by document.

All states are written to the shared folder, and random numbers depend on part and sweep, so a lost task is redone the
same. Words count exactly for the base; in pairs they are 40-bit hashes.

Defined cases: null or empty text has only its end, which is a token and a word of the vocabulary;
repeated rows are scored, and learnt from, each; without training rows every probability is 1.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from usagemart.llm.byte_pairs import _pack, _unpack
from usagemart.llm.rows import learns, small, stored, texts
from usagemart.session import scratch_scope

SWEEPS, KEPT = 3, 2
ROUNDS = 256  # of a sweep; a dish with more customers moves as many groups of them
STRENGTH = 1.0
BLOCK_BYTES = 8_000_000  # larger blocks name fewer pairs twice
PART_BYTES, MOST_PARTS = 4_000_000, 20_000  # of text behind a part
HOT, SAMPLE = 500, 64  # one document in so many tells which restaurants are hot, and how many parts there are
TRAIN_PARTS = 7
_END_OF_TEXT = b""  # no word is empty
_SEPARATOR = b"\n"  # no word holds white space
_START = np.uint64(1 << 40)  # the restaurant of first words; hashes are smaller
_WORDS, _PAIRS, _SEQUENCE = range(3)
_EXCHANGE = "block bigint, kind int, part int, check_sum bigint, content binary"


def tokens(text: str) -> list[bytes]:
    """Words of a text, A to Z in lower case, and its end. Bytes know ASCII letters and blanks only."""
    return [*text.encode().lower().split(), _END_OF_TEXT]


def trains(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % TRAIN_PARTS != 2


def hash_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> 24


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


# -- blocks ------------------------------------------------------------------------------------

@dataclass
class Plan:
    """How many parts there are, and the hot restaurants, in order."""

    parts: int
    hot: np.ndarray

    def of_pairs(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        hot = np.isin(before, self.hot)
        return (_mixed(np.where(hot, before * np.uint64(31) + word, before)) % np.uint64(self.parts)).astype(np.int64)


@dataclass
class Block:
    number: int
    ids: pa.Array
    sizes: np.ndarray  # tokens of each document
    words: list[bytes]  # distinct, in order of part and hash
    word_part: np.ndarray
    word_counts: np.ndarray  # in training documents
    before: np.ndarray  # hashes of each distinct pair, in order of part, word before and word
    word: np.ndarray
    pair_part: np.ndarray
    pair_counts: np.ndarray
    word_of_pair: np.ndarray  # by place in ``words``
    pairs: np.ndarray  # of each token

    def check_sum(self) -> int:
        return zlib.crc32(_SEPARATOR.join(self.words))


def _numbered(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """As ``tokens`` has them of each text: how many, the number of each, and the distinct ones by number."""
    listed = pc.ascii_split_whitespace(pc.ascii_lower(column)).combine_chunks()  # has empty words at a text's edges
    coded = listed.flatten().dictionary_encode()
    known, code = coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy()
    end = known.index(_END_OF_TEXT) if _END_OF_TEXT in known else len(known)
    known[end:] = known[end:] or [_END_OF_TEXT]
    there = np.r_[0, np.cumsum(code != end)]
    bounds = there[listed.offsets.to_numpy() - listed.offsets[0].as_py()]
    return np.diff(bounds) + 1, np.insert(code[code != end].astype(np.int64), bounds[1:], end), known


def _by_part(part: np.ndarray, first: np.ndarray, second: np.ndarray, kinds: int) -> np.ndarray:
    """The order by part, first and second of pairs of numbers below ``kinds``."""
    bits = np.uint64(kinds.bit_length())
    if int(bits) * 2 + int(part.max(initial=0)).bit_length() > 64:
        return np.lexsort((second, first, part))
    return np.argsort((part.astype(np.uint64) << bits | first.astype(np.uint64)) << bits | second.astype(np.uint64))


def _blocks(batches: Iterator[pa.RecordBatch], plan: Plan) -> Iterator[Block]:
    task, made = TaskContext.get().partitionId(), count()

    def close() -> Block:
        sizes, seen, listed = _numbered(pa.chunked_array(pieces))
        n, training = len(listed), list(map(trains, ids))
        hashes = np.fromiter(map(hash_of, listed), np.uint64, n)
        part = (hashes % np.uint64(plan.parts)).astype(np.int64)
        order = np.lexsort((hashes, part))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        seen = place[seen]
        hashes, trained = np.append(hashes[order], _START), np.repeat(training, sizes)
        before = np.r_[n, seen[:-1]]
        before[np.r_[0, np.cumsum(sizes)[:-1]]] = n
        keys, inverse = np.unique(before * (n + 1) + seen, return_inverse=True)
        before, word = np.divmod(keys, n + 1)
        first, second = hashes[before], hashes[word]
        pair_part = plan.of_pairs(first, second)
        known, by_hash = np.unique(hashes, return_inverse=True)
        by_part = _by_part(pair_part, by_hash[before], by_hash[word], len(known))
        rank = np.empty(len(keys), np.int64)
        rank[by_part] = np.arange(len(keys))
        pairs = rank[inverse]
        return Block((task << 32) + next(made), pa.array(ids, id_type), sizes,
                     [listed[i] for i in order], part[order], np.bincount(seen, trained, n).astype(np.uint32),
                     first[by_part], second[by_part], pair_part[by_part],
                     np.bincount(pairs, trained, len(keys)).astype(np.uint32), word[by_part], pairs)

    ids, pieces, size = [], [], 0
    id_type = pa.null()
    for batch in small(batches):
        id_type, begin = batch.column(0).type, 0
        for i, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
            size += n
            if size >= BLOCK_BYTES or i + 1 == len(batch):
                taken = batch.slice(begin, i + 1 - begin)
                ids += taken.column(0).to_pylist()
                pieces.append(taken.column(1))
                begin = i + 1
            if size >= BLOCK_BYTES:
                yield close()
                ids, pieces, size = [], [], 0
    if ids:
        yield close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    columns = zip(*rows) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                      ["block", "kind", "part", "check_sum", "content"])


def _join(*pieces: bytes) -> bytes:
    return b"".join(len(piece).to_bytes(4, "little") + piece for piece in pieces)


def _split(joined: bytes) -> list[bytes]:
    found, at = [], 0
    while at < len(joined):
        size = int.from_bytes(joined[at:at + 4], "little")
        found.append(joined[at + 4:at + 4 + size])
        at += 4 + size
    return found


def _pack_hashes(hashes: np.ndarray) -> bytes:
    """Six bytes of each."""
    return zstandard.compress(np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes(), 1)


def _unpack_hashes(packed: bytes) -> np.ndarray:
    kept = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(-1, 6)
    return np.hstack([kept, np.zeros((len(kept), 2), np.uint8)]).view("<u8").ravel()


def _pack_long(values: np.ndarray) -> bytes:
    """Counts of the whole corpus, which may pass 32 bits."""
    values = np.asarray(values).astype("<u8")
    return _join(_pack(values & np.uint64(0xFFFFFFFF)), _pack(values >> np.uint64(32)))


def _unpack_long(packed: bytes) -> np.ndarray:
    low, high = map(_unpack, _split(packed))
    return low.astype(np.int64) | high.astype(np.int64) << 32


def _floats(values: np.ndarray) -> bytes:
    """With 11 bits after the first, a relative error of 0.02 % at most: the others would not compress."""
    bits = values.astype("<f4").view("<u4")
    return _pack((bits + np.uint32(0x800)) & np.uint32(0xFFFFF000))


def _as_floats(packed: bytes) -> np.ndarray:
    return _unpack(packed).view("<f4").astype(np.float64)


def _runs(before: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.r_[True, before[1:] != before[:-1]][:len(before)])


def _deal(plan: Plan):
    def task(batches):
        for block in _blocks(batches, plan):
            total, rows, edges = block.check_sum(), [], np.arange(plan.parts + 1)
            bounds = np.searchsorted(block.word_part, edges).tolist()
            for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if a < b:
                    rows.append((block.number, _WORDS, part, total, _join(
                        zstandard.compress(_SEPARATOR.join(block.words[a:b]), 1), _pack(block.word_counts[a:b]))))
            bounds = np.searchsorted(block.pair_part, edges).tolist()
            for part, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if a < b:
                    first = _runs(block.before[a:b])
                    rows.append((block.number, _PAIRS, part, total, _join(
                        _pack_hashes(block.before[a:b][first]), _pack(np.diff(np.append(first, b - a))),
                        _pack_hashes(block.word[a:b]), _pack(block.pair_counts[a:b]))))
                if len(rows) >= 1000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)
    return task


def _sequences(plan: Plan):
    def task(batches):
        for block in _blocks(batches, plan):
            sink = pa.BufferOutputStream()
            docs = pa.RecordBatch.from_arrays([block.ids, pa.array(block.sizes, pa.int64())], ["doc_id", "n"])
            with pa.ipc.new_stream(sink, docs.schema) as stream:
                stream.write_batch(docs)
            # Restaurants of a part are told apart by place, as in its answers.
            new = np.r_[True, (block.before[1:] != block.before[:-1]) | (block.pair_part[1:] != block.pair_part[:-1])]
            content = _join(sink.getvalue().to_pybytes(), _pack(block.pairs), _pack(block.word_of_pair), _pack(new))
            yield _batch([(block.number, _SEQUENCE, -1, block.check_sum(), content)])
    return task


# -- parts -------------------------------------------------------------------------------------

_REQUESTS = T.ArrayType(T.StructType().add("block", "long").add("check_sum", "long").add("content", "binary"))
_PART = (T.StructType().add("kind", "integer").add("part", "integer").add("state", "binary").add("requests", _REQUESTS)
         .add("seats", "binary").add("tables_of", T.ArrayType(T.LongType())).add("tables", T.ArrayType(T.LongType()))
         .add("mobile", T.ArrayType(T.LongType())).add("hot", T.ArrayType(T.LongType()))
         .add("sums", T.ArrayType(T.LongType())))


def _part_row(part: int, kind: int, state: bytes, requests: list, seats: bytes | None = None, tables_of=(), tables=(),
              mobile=(), hot=(), sums=()) -> pa.Table:
    schema = pa.schema([
        ("kind", pa.int32()), ("part", pa.int32()), ("state", pa.binary()),
        ("requests", pa.list_(pa.struct([("block", pa.int64()), ("check_sum", pa.int64()), ("content", pa.binary())]))),
        ("seats", pa.binary()), *((name, pa.list_(pa.int64())) for name in ("tables_of", "tables", "mobile", "hot", "sums"))])
    values = [kind, part, state, [dict(zip(("block", "check_sum", "content"), r)) for r in requests], seats,
              *(np.asarray(x).astype(np.int64) for x in (tables_of, tables, mobile, hot, sums))]
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _add_up(plan: Plan):
    def words(part: int, rows) -> pa.Table:
        """A part's words with their counts, and by block the words that were asked for."""
        numbers, asked, counts = defaultdict(count().__next__), [], []
        for block, check_sum, content in rows:
            listed, seen = _split(content)
            at = np.fromiter(map(numbers.__getitem__, zstandard.decompress(listed).split(_SEPARATOR)), np.int64)
            asked.append((block, check_sum, _pack(at)))
            counts.append((at, _unpack(seen)))
        total = np.zeros(len(numbers), np.int64)
        for at, seen in counts:
            total[at] += seen
        hashes = np.fromiter(map(hash_of, numbers), np.uint64, len(numbers))
        return _part_row(part, _WORDS, _join(_pack_hashes(hashes), _pack_long(total)), asked,
                         sums=[(total > 0).sum(), total.sum(), 0, 0])

    def pairs(part: int, rows) -> pa.Table:
        """A part's restaurants: customers of their dishes, tables by word, and the sizes of tables that can change."""
        asked, befores, followers, counts = [], [], [], []
        for block, check_sum, content in rows:
            before, sizes, word, seen = _split(content)
            befores.append(np.repeat(_unpack_hashes(before), _unpack(sizes)))
            followers.append(_unpack_hashes(word))
            counts.append(_unpack(seen))
            asked.append((block, check_sum))
        before, word = np.concatenate(befores), np.concatenate(followers)
        order = np.lexsort((word, before))
        new = np.r_[True, (np.diff(before[order]) != 0) | (np.diff(word[order]) != 0)]
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        customers = np.bincount(place, np.concatenate(counts)).astype(np.int64)
        before, word = before[order][new], word[order][new]
        bounds = np.cumsum([0, *map(len, counts)])
        requests = [(*who, _pack(np.diff(place[a:b], prepend=0))) for who, a, b in zip(asked, bounds, bounds[1:])]
        first = _runs(before)
        restaurant = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(before))))
        there, mobile = customers > 0, np.flatnonzero(customers > 1)
        tables_of, tables = np.unique(word[there], return_counts=True)
        moving, of_word = np.unique(word[mobile], return_inverse=True)
        fixed = np.bincount(restaurant, customers == 1, len(first)).astype(np.int64)
        total = np.bincount(restaurant, customers, len(first)).astype(np.int64)
        hot = np.flatnonzero(np.isin(before[first], plan.hot))
        place_in_hot = np.searchsorted(plan.hot, before[first][hot])
        seats = _join(_pack(restaurant[mobile]), _pack(of_word), _pack(np.ones(len(mobile), int)), _pack_long(customers[mobile]),
                      _pack(fixed), _pack(hot), _pack(place_in_hot))
        state = _join(_pack(np.diff(np.append(first, len(before)))), _pack_long(customers), _pack_long(total), _pack(hot),
                      _pack(place_in_hot))
        hot_rows = np.stack([place_in_hot, total[hot], np.bincount(restaurant, there, len(first))[hot]], 1).ravel()
        return _part_row(part, _PAIRS, state, requests, seats, tables_of, tables, moving, hot_rows,
                         [0, 0, (customers == 1).sum(), (customers == 2).sum()])

    def group(table: pa.Table) -> pa.Table:
        kind, part = table["kind"][0].as_py(), table["part"][0].as_py()
        rows = zip(table["block"].to_pylist(), table["check_sum"].to_pylist(),
                   (content.as_py() for content in table["content"]))
        return (words if kind == _WORDS else pairs)(part, rows)

    return group


# -- seats -------------------------------------------------------------------------------------

class Seats:
    """Tables of some dishes, in order of the dishes."""

    def __init__(self, dishes: int, dish: np.ndarray, size: np.ndarray, discount: float, dice: np.random.Generator):
        self.dishes, self.dish, self.size = dishes, dish.astype(np.int64), size.astype(np.float64)
        self.discount, self.dice = discount, dice

    def tables(self) -> np.ndarray:
        return np.bincount(self.dish, minlength=self.dishes)

    def customers(self) -> np.ndarray:
        return np.bincount(self.dish, self.size, self.dishes)

    def _pick(self, chosen: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For each of the chosen dishes one of its tables, by weight."""
        below = np.r_[0, np.cumsum(weight)]
        first, after = np.searchsorted(self.dish, chosen), np.searchsorted(self.dish, chosen, "right")
        at = below[first] + self.dice.random(len(chosen)) * (below[after] - below[first])
        return np.clip(np.searchsorted(below, at, "right") - 1, first, after - 1)

    def leave(self, chosen: np.ndarray, n: np.ndarray | int = 1) -> np.ndarray:
        """A customer of each chosen dish leaves, or up to ``n`` of one table; returns how many did, and drops empty tables."""
        at = self._pick(chosen, self.size)
        gone = np.minimum(self.size[at], n)
        self.size[at] -= gone
        self.dish, self.size = self.dish[self.size > 0], self.size[self.size > 0]
        return gone

    def arrive(self, chosen: np.ndarray, new: np.ndarray, n: np.ndarray | int = 1) -> None:
        """``n`` customers of each chosen dish take seats; ``new``: weight of opening a table. Those of a group who open
        none sit together."""
        n = np.broadcast_to(n, chosen.shape).astype(np.int64)
        old = (self.customers() - self.discount * self.tables())[chosen]
        opened = self.dice.binomial(n, new / (new + old))
        opened = np.where((old <= 0) & (opened == 0), 1, opened)
        stay = n > opened
        if stay.any():
            has = stay & (old > 0)
            at = self._pick(chosen[has], self.size - self.discount)
            self.size[at] += (n - opened)[has]
            opened = np.where(stay & ~has, n, opened)
        self.dish = np.r_[self.dish, np.repeat(chosen, opened)]
        self.size = np.r_[self.size, np.ones(opened.sum())]
        order = np.argsort(self.dish, kind="stable")
        self.dish, self.size = self.dish[order], self.size[order]

    def move(self, opening: Callable, moved: Callable = lambda closed, opened: None, moves: int | None = None) -> None:
        """Each customer in turn leaves and is seated anew given all others; or ``moves`` customers of each dish do.

        Dishes move at once, given the round before. The customers of a dish with more than ``ROUNDS`` go round in
        ``ROUNDS`` groups, each given all others of the dish. ``opening``: of dishes and how many of their tables are empty
        now, the weight of opening a table; ``moved`` hears of the dishes of tables closed and opened in a round.
        """
        n, now = self.customers().astype(np.int64), self.tables()
        start = np.cumsum(n) - n
        # Table of each customer, by dish, and in random order: whose turn it is must not depend on where they sit.
        seat = np.repeat(np.arange(len(self.dish)), self.size.astype(np.int64))
        seat = seat[np.argsort(np.repeat(np.arange(self.dishes), n) + self.dice.random(len(seat)))]
        size, known = self.size.astype(np.int64), len(self.dish)
        ordered = np.argsort(-n, kind="stable")
        ordered = ordered[:np.count_nonzero(n > 1)]  # who is alone has one table, whatever happens
        many = np.count_nonzero(n > ROUNDS) if moves is None else 0
        groups, going = ordered[:many], -n[ordered]
        rounds = (min(int(-going[0]), ROUNDS) if moves is None else moves) if len(ordered) else 0
        for turn in range(rounds):
            dish = ordered if moves is not None else ordered[:np.searchsorted(going, -turn)]
            first, gone = (turn % n[dish], 1) if moves is not None else (turn, 1)
            if many:
                low = n[groups] * turn // ROUNDS
                g = n[groups] * (turn + 1) // ROUNDS - low
                single = len(dish) - many
                dish = np.concatenate([np.repeat(groups, g), dish[many:]])
                gone = np.concatenate([np.repeat(g, g), np.ones(single, np.int64)])
                first = np.concatenate([np.repeat(low, g), np.full(single, turn)])
                within = np.concatenate([np.arange(g.sum()) - np.repeat(np.cumsum(g) - g, g), np.zeros(single, np.int64)])
                who = start[dish] + first + within
            else:
                who = start[dish] + first
            was, table = now[dish], seat[who]
            np.subtract.at(size, table, 1)
            empty = np.flatnonzero(size[table] == 0)
            if many:
                empty = empty[np.unique(table[empty], return_index=True)[1]]
            closed = dish[empty]
            np.subtract.at(now, closed, 1)
            there, others = now[dish], n[dish] - gone
            new = opening(dish, was - there)
            opens = self.dice.random(len(dish)) * (new + others - self.discount * there) < new
            # Others join the table of a customer who stayed, which goes by size; some picks are refused to take off the
            # discount, in proportion to the largest share that a table of the dish can have.
            largest = others - there + 1
            most = 1 - self.discount / np.maximum(largest, 1)
            left = np.flatnonzero(~opens)
            while len(left):
                stay = (self.dice.random(len(left)) * others[left]).astype(np.int64)
                from_ = first[left] if np.ndim(first) else first
                stay += np.where(stay >= from_, gone[left] if np.ndim(gone) else gone, 0)
                picked = seat[start[dish[left]] + stay]
                held = size[picked]
                taken = self.dice.random(len(left)) * most[left] * held < held - self.discount
                table[left[taken]] = picked[taken]
                left = left[~taken]
            opened = dish[opens]
            table[opens] = known + np.arange(len(opened))
            known += len(opened)
            if known > len(size):
                size = np.concatenate([size, np.zeros(max(known - len(size), len(size) // 2), np.int64)])
            np.add.at(size, table, 1)
            np.add.at(now, opened, 1)
            seat[who] = table
            moved(closed, opened)
        of = np.zeros(known, np.int64)
        of[seat] = np.repeat(np.arange(self.dishes), n)
        held = np.flatnonzero(size[:known])
        held = held[np.argsort(of[held], kind="stable")]
        self.dish, self.size = of[held], size[held].astype(np.float64)


def sweep_dishes(seats: Seats, restaurant: np.ndarray, tables: np.ndarray, chance: np.ndarray, moves: int | None = None) -> None:
    """Gibbs moves of every customer of all dishes of restaurants, or of ``moves`` for each dish. ``tables``: of each
    restaurant, beside those of ``seats``; ``chance``: the root's probability of each dish."""
    total = tables + np.bincount(restaurant, seats.tables(), len(tables))

    def opening(dish: np.ndarray, own: np.ndarray) -> np.ndarray:
        return (STRENGTH + seats.discount * (total[restaurant[dish]] - own)) * chance[dish]

    def moved(closed: np.ndarray, opened: np.ndarray) -> None:
        np.subtract.at(total, restaurant[closed], 1)
        np.add.at(total, restaurant[opened], 1)

    seats.move(opening, moved, moves)


def sweep_root(seats: Seats, change: np.ndarray, new: float) -> None:
    """Customers who came and went since the last sweep, then Gibbs moves of every customer. Many come and go in groups of a sixteenth of
    those there. ``new``: weight of opening a table."""
    left = np.maximum(-change, 0)
    while left.any():
        at = np.flatnonzero(left)
        left[at] -= seats.leave(at, np.minimum(left[at], np.maximum(seats.customers()[at] // 16, 1))).astype(np.int64)
    left = np.maximum(change, 0)
    while left.any():
        at = np.flatnonzero(left)
        n = np.minimum(left[at], np.maximum(seats.customers()[at] // 16, 1)).astype(np.int64)
        seats.arrive(at, np.full(len(at), new), n)
        left[at] -= n
    seats.move(lambda dish, own: np.full(len(dish), new))


def _discount(once: float, twice: float) -> float:
    """Share of a customer that new tables take, from how many dishes were had once and twice."""
    return float(np.clip(once / (once + 2 * twice), 0.05, 0.95)) if once + twice else 0.5


# -- sweeps ------------------------------------------------------------------------------------

@dataclass
class Totals:
    """What every task knows of all others."""

    vocabulary: int
    tokens: int
    discount: float
    root_discount: float = 0.5
    root_customers: int = 0
    root_tables: int = 0
    hot_customers: np.ndarray | None = None
    hot_tables: np.ndarray | None = None

    @property
    def opening(self) -> float:
        """Weight of a new table at the root."""
        return (STRENGTH + self.root_discount * self.root_tables) / (self.vocabulary + 1)

    def root_chance(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        return (customers - self.root_discount * tables + self.opening) / (STRENGTH + self.root_customers)


def _of_hot(sums: DataFrame, n: int) -> np.ndarray:
    """Adds up (place, customers, tables) triples; the result has a fixed size."""
    found = np.zeros((n, 2))
    triples = F.expr("transform(sequence(0, CAST(size(hot) / 3 AS INT) - 1), i -> struct("
                     "hot[3 * i] AS place, hot[3 * i + 1] AS customers, hot[3 * i + 2] AS tables))")
    rows = sums.where("size(hot) > 0").select(F.explode(triples).alias("h")).groupBy("h.place").agg(
        F.sum("h.customers").alias("customers"), F.sum("h.tables").alias("tables"))
    for place, customers, tables in rows.collect():
        found[place] = customers, tables
    return found


def _pair_sweep(totals: Totals, turn: int):
    """(state of a part, the root's answers) -> its next state, and the change of tables by word."""
    def group(state: pa.Table, answers: pa.Table) -> pa.Table:
        part = state["part"][0].as_py()
        pieces = _split(state["seats"][0].as_py())
        restaurant, of_word, tables, size, fixed, hot, in_hot = (
            _unpack_long(piece) if i == 3 else _unpack(piece).astype(np.int64) for i, piece in enumerate(pieces))
        chance = np.zeros(len(answers))
        chance[answers["place"].to_numpy()] = answers["chance"].to_numpy()
        dish = np.repeat(np.arange(len(restaurant)), tables)
        seats = Seats(len(restaurant), dish, size, totals.discount, np.random.default_rng([17, part, turn]))
        others = fixed.astype(np.float64)
        # Of a hot restaurant, what other parts hold.
        others[hot] += totals.hot_tables[in_hot] - fixed[hot] - np.bincount(restaurant, tables, len(fixed))[hot]
        sweep_dishes(seats, restaurant, others, chance[of_word])
        now = seats.tables()
        change = np.bincount(of_word, now - tables, len(chance)).astype(np.int64)
        at = np.flatnonzero(change)
        mobile = state["mobile"].combine_chunks().flatten().to_numpy()
        held = (fixed + np.bincount(restaurant, now, len(fixed)))[hot].astype(np.int64)
        blob = _join(pieces[0], pieces[1], _pack(now), _pack_long(seats.size), *pieces[4:])
        listed = pa.list_(pa.int64())
        return pa.table({
            "part": pa.array([part], pa.int32()), "seats": pa.array([blob], pa.binary()),
            "mobile": pa.array([mobile], listed), "tables_of": pa.array([mobile[at]], listed),
            "tables": pa.array([change[at]], listed),
            "hot": pa.array([np.stack([in_hot, np.zeros_like(in_hot), held], 1).ravel()], listed)})
    return group


_STATE = "part int, seats binary, mobile array<bigint>, tables_of array<bigint>, tables array<bigint>, hot array<bigint>"


def _changes(state: DataFrame) -> DataFrame:
    """(word, change) of the root's customers."""
    return state.select(F.explode(F.arrays_zip("tables_of", "tables")).alias("x")).groupBy(
        F.col("x.tables_of").alias("word")).agg(F.sum("x.tables").alias("change"))


def _root_sweep(totals: Totals, turn: int):
    """(word, sizes, change) -> (word, sizes, customers, tables) of the root."""
    def task(batches):
        for n, piece in enumerate(small(batches, 100_000)):
            sizes = piece.column("sizes")
            dish = np.repeat(np.arange(len(piece)), np.diff(sizes.offsets.to_numpy()))
            seats = Seats(len(piece), dish, sizes.flatten().to_numpy(zero_copy_only=False), totals.root_discount,
                          np.random.default_rng([19, TaskContext.get().partitionId(), n, turn]))
            sweep_root(seats, piece.column("change").to_numpy(zero_copy_only=False).astype(np.int64), totals.opening)
            tables = seats.tables()
            bounds = pa.array(np.r_[0, np.cumsum(tables)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [piece.column("word"), pa.ListArray.from_arrays(bounds, pa.array(seats.size.astype(np.int64))),
                 pa.array(seats.customers().astype(np.int64)), pa.array(tables.astype(np.int64))],
                ["word", "sizes", "customers", "tables"])
    return task


def train(parts: DataFrame, plan: Plan) -> tuple[Totals, list[tuple[Totals, DataFrame, DataFrame]]]:
    """Runs the sweeps; returns (totals, root, states of parts) of each that is kept. Only sums of fixed size come to
    the driver."""
    words, tokens, once, twice = (int(n or 0) for n in parts.agg(
        *(F.sum(F.col("sums")[i]) for i in range(4))).first())
    pairs = parts.where(F.col("kind") == _PAIRS)
    state = pairs.select("part", "seats", "mobile", "tables_of", "tables", "hot")
    hot = _of_hot(pairs, len(plan.hot))
    totals = Totals(words, tokens, _discount(once, twice), hot_customers=hot[:, 0], hot_tables=hot[:, 1])
    # At first every dish has one table, in its restaurant and at the root.
    root = stored(_changes(state).select(
        "word", F.array("change").alias("sizes"), F.col("change").alias("customers"), F.lit(1).cast("long").alias("tables")),
        "root")
    subscribed = stored(state.select("part", F.posexplode("mobile").alias("place", "word")), "subscribed")
    once, twice = root.agg(F.count_if(F.col("customers") == 1), F.count_if(F.col("customers") == 2)).first()
    totals.root_discount = _discount(once, twice)

    def at_root(root: DataFrame, totals: Totals) -> Totals:
        customers, tables = root.agg(F.sum("customers"), F.sum("tables")).first()
        return Totals(**{**vars(totals), "root_customers": customers or 0, "root_tables": tables or 0})

    totals, kept = at_root(root, totals), []
    for turn in range(SWEEPS):
        chance = (F.col("customers") - totals.root_discount * F.col("tables") + totals.opening) / (
            STRENGTH + totals.root_customers)
        answers = subscribed.join(root.select("word", chance.alias("chance")), "word").select("part", "place", "chance")
        state = stored(state.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
            _pair_sweep(totals, turn), _STATE), "seats")
        moved = root.select("word", "sizes").join(_changes(state), "word", "left").select(
            "word", "sizes", F.coalesce("change", F.lit(0)).cast("long").alias("change")).sortWithinPartitions("word")
        root = stored(moved.mapInArrow(_root_sweep(totals, turn),
                                       "word bigint, sizes array<bigint>, customers bigint, tables bigint"), "root")
        totals = at_root(root, Totals(**{**vars(totals), "hot_tables": _of_hot(state, len(plan.hot))[:, 1]}))
        if turn >= SWEEPS - KEPT:
            kept.append((totals, root, state))
    return totals, kept


# -- answers -----------------------------------------------------------------------------------

def _word_answers(kept: list[Totals]):
    """For each request: counts of its words, and their probabilities at the root in each kept sweep."""
    def group(state: pa.Table, roots: pa.Table) -> pa.Table:
        part = state["part"][0].as_py()
        hashes, counts = _split(state["state"][0].as_py())
        hashes, counts = _unpack_hashes(hashes), _unpack_long(counts)
        chances = []
        for i, totals in enumerate(kept):
            of = roots.filter(pa.array(roots["sweep"].to_numpy() == i))
            order = np.argsort(of["word"].to_numpy())
            word, customers, tables = (of[name].to_numpy()[order] for name in ("word", "customers", "tables"))
            chance = np.full(len(hashes), totals.root_chance(0, 0))
            if len(word):
                at = np.minimum(np.searchsorted(word, hashes.astype(np.int64)), len(word) - 1)
                # A word that training documents lack is unknown, even if it shares the hash of one that they have.
                there = (word[at] == hashes.astype(np.int64)) & (counts > 0)
                chance[there] = totals.root_chance(customers[at][there], tables[at][there])
            chances.append(chance)
        rows = []
        for request in state["requests"][0].as_py():
            at = _unpack(request["content"])
            rows.append((request["block"], _WORDS, part, request["check_sum"],
                         _join(_pack_long(counts[at]), *(_floats(chance[at]) for chance in chances))))
        return pa.Table.from_batches([_batch(rows)])
    return group


def _pair_answers(kept: list[Totals]):
    """For each request: the mean of what pairs have of their own, and the restaurants' shares of the root in each sweep."""
    def group(state: pa.Table, sweeps: pa.Table) -> pa.Table:
        part = state["part"][0].as_py()
        sizes, customers, total, hot, in_hot = (
            _unpack_long(piece) if i in (1, 2) else _unpack(piece).astype(np.int64)
            for i, piece in enumerate(_split(state["state"][0].as_py())))
        restaurant, mobile = np.repeat(np.arange(len(sizes)), sizes), np.flatnonzero(customers > 1)
        total, own, shares = total.astype(np.float64), np.zeros(len(customers)), []
        if len(hot):
            total[hot] = kept[0].hot_customers[in_hot]
        for i, totals in enumerate(kept):
            blob = sweeps["seats"][int(np.flatnonzero(sweeps["sweep"].to_numpy() == i)[0])].as_py()
            tables = (customers > 0).astype(np.float64)
            tables[mobile] = _unpack(_split(blob)[2])
            open_ = np.bincount(restaurant, tables, len(sizes))
            if len(hot):
                open_[hot] = totals.hot_tables[in_hot]
            own += (customers - totals.discount * tables) / (STRENGTH + total[restaurant]) / len(kept)
            shares.append((STRENGTH + totals.discount * open_) / (STRENGTH + total))
        rows = []
        for request in state["requests"][0].as_py():
            at = np.cumsum(_unpack(request["content"]), dtype=np.uint32)
            there = restaurant[at]
            there = there[_runs(there)]
            rows.append((request["block"], _PAIRS, part, request["check_sum"],
                         _join(_floats(own[at]), *(_floats(share[there]) for share in shares))))
        return pa.Table.from_batches([_batch(rows)])
    return group


def _scored(totals: Totals):
    def block(group: pa.Table) -> pa.Table:
        kind, part = group["kind"].to_numpy(), group["part"].to_numpy()
        order = np.lexsort((part, kind))
        if kind[order[-1]] != _SEQUENCE or len(set(group["check_sum"].to_pylist())) > 1:
            raise ValueError("documents changed while they were scored")

        def answers(wanted: int) -> list[np.ndarray]:
            """The answers of all parts, piece by piece."""
            found = [_split(group["content"][int(i)].as_py()) for i in order if kind[i] == wanted]
            return [np.concatenate(pieces) for pieces in zip(*(
                [_unpack_long(p) if wanted == _WORDS and k == 0 else _as_floats(p) for k, p in enumerate(row)] for row in found))]

        raw, pairs, word_of_pair, new = _split(group["content"][int(order[-1])].as_py())
        docs = pa.ipc.open_stream(raw).read_all()
        pairs, word_of_pair, restaurant = _unpack(pairs), _unpack(word_of_pair), np.cumsum(_unpack(new)) - 1
        counts, *chances = answers(_WORDS)
        base = np.log10((counts + 1.0) / (totals.tokens + totals.vocabulary + 1))
        if totals.tokens:
            own, *shares = answers(_PAIRS)
            mean = own + sum(s[restaurant] * c[word_of_pair] for s, c in zip(shares, chances)) / len(shares)
            logs = np.log10(mean)
        else:
            logs = np.zeros(len(word_of_pair))
        sizes, word = docs["n"].to_numpy(), word_of_pair[pairs]
        starts = np.cumsum(sizes) - sizes
        return pa.table({
            "doc_id": docs["doc_id"], "n_tokens": docs["n"],
            "n_known": pa.array(np.add.reduceat((counts[word] > 0).astype(np.int64), starts)),
            "base_score": pa.array(np.add.reduceat(base[word], starts)),
            "score": pa.array(np.add.reduceat(logs[pairs], starts))})
    return block


# -- the whole ---------------------------------------------------------------------------------

def plan_of(rows: DataFrame, least: int) -> Plan:
    """From a sample of the documents: how many parts their bytes take, and words that precede many. It
    decides where work is done, not what comes out."""
    def task(batches):
        seen, size = Counter(), 0
        for piece in small(batches):
            for text in piece.column("text"):
                size += len(text.as_buffer()) + 1
                seen.update(tokens(text.as_py()))
        total = seen.total()
        often = [(hash_of(word), n) for word, n in seen.items() if n * HOT * 2 > total]
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *(h for h, _ in often)], pa.int64()),
                                          pa.array([size, total, *(n for _, n in often)], pa.int64())], ["word", "n"])

    # Of all words of a task, fewer than 2 HOT are so frequent.
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0)
    found = dict(chosen.mapInArrow(task, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
                 .orderBy(F.desc("n")).limit(2 * HOT + 2).collect())
    size, total = found.pop(-1, 0) * SAMPLE, found.pop(-2, 0)
    end = hash_of(_END_OF_TEXT)
    hot = [word for word, n in found.items() if n * HOT > total and word != end]  # nothing follows an end
    return Plan(min(max(least, size // PART_BYTES), MOST_PARTS), np.sort(np.array([*hot, int(_START)], np.uint64)))


def scores(documents: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, train_tokens, held_out, perplexity) of every row, stored."""
    with scratch_scope(documents.sparkSession) as keep:
        return keep(_scores(documents), "scores")


def _scores(documents: DataFrame) -> DataFrame:
    rows = texts(documents)
    plan = plan_of(rows, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.mapInArrow(_deal(plan), _EXCHANGE)
    parts = stored(dealt.groupBy("kind", "part").applyInArrow(_add_up(plan), _PART), "parts")
    totals, kept = train(parts, plan)
    known = [of_sweep for of_sweep, _, _ in kept]
    words = parts.where(F.col("kind") == _WORDS).select("part", "state", "requests")
    pairs = parts.where(F.col("kind") == _PAIRS).select("part", "state", "requests")

    def of_sweeps(frames: list[DataFrame]) -> DataFrame:
        found = [frame.withColumn("sweep", F.lit(i)) for i, frame in enumerate(frames)]
        whole = found[0]
        for frame in found[1:]:
            whole = whole.unionByName(frame)
        return whole

    roots = of_sweeps([root.select("word", "customers", "tables") for _, root, _ in kept]).withColumn(
        "part", (F.col("word") % plan.parts).cast("int"))
    seats = of_sweeps([state.select("part", "seats") for _, _, state in kept])
    answers = [words.groupBy("part").cogroup(roots.groupBy("part")).applyInArrow(_word_answers(known), _EXCHANGE),
               pairs.groupBy("part").cogroup(seats.groupBy("part")).applyInArrow(_pair_answers(known), _EXCHANGE)]
    asked = rows.mapInArrow(_sequences(plan), _EXCHANGE).unionByName(answers[0]).unionByName(answers[1])
    out = T.StructType([
        rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return (asked.groupBy("block").applyInArrow(_scored(totals), out)
            .withColumn("train_tokens", F.lit(totals.tokens).cast("long"))
            .withColumn("held_out", ~learns("doc_id", TRAIN_PARTS))
            .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"))
