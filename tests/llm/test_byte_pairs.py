from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.cases import by_id, corpus, documents, empty
from usagemart.llm import byte_pairs

RANKS = byte_pairs.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def run(rows):
    encoded = byte_pairs.encode(rows, RANKS, public_tokenizers.PATTERN)
    return byte_pairs.digests(byte_pairs.decode(encoded, RANKS)).collect()


def test_ids_and_round_trip_equal_the_library(spark, monkeypatch):
    dice = random.Random(1)
    mixed = ["".join(dice.choice("ab 's\n\t\x1c\x85\xa0é中😀1²'٣ll ") for _ in range(dice.randint(0, 60)))
             for _ in range(300)]
    rows = corpus(spark).select("doc_id", "text").unionByName(
        documents(spark, mixed, 20_000_000).select("doc_id", "text")).repartition(5).persist()
    found = run(rows)
    assert len(found) == rows.count()
    got = by_id(found)
    for row in rows.collect():
        text = row.text or ""
        ids = LIBRARY.encode_ordinary(text)
        assert (got[row.doc_id].n_tokens, got[row.doc_id].ids_sha256, got[row.doc_id].decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_blocks_of_one_document(spark, monkeypatch):
    monkeypatch.setattr(byte_pairs, "BLOCK_CHARS", 1)
    rows = documents(spark)
    assert {r.doc_id: r.n_tokens for r in run(rows)} == {
        r.doc_id: len(LIBRARY.encode_ordinary(r.text or "")) for r in rows.collect()}


@pytest.mark.parametrize("word", [b"a", b"ab" * 500, b"\xff\xfe", "ciónmenteíñ".encode(), b" thereof"])
def test_merges(word):
    assert byte_pairs.merge(word, RANKS) == LIBRARY._core_bpe.encode_single_piece(word)


def test_empty_table(spark):
    assert run(empty(spark)) == []
