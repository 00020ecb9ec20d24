from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline
from tests.compare import spark_rows, sql_rows
from tests.llm.cases import SF, clashing, corpus, empty
from usagemart.llm import byte_pairs, decontaminate, near_duplicates, queries, secret_scan, toxicity


def test_stages_keep_columns_and_take_effect(spark):
    docs = corpus(spark).persist()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF).persist()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert result.columns == docs.columns
        seen[name], docs = (docs, result), result
    labels, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))

    def ids(rows):
        return sorted(r.doc_id if r.doc_id is not None else -1 for r in rows.select("doc_id").collect())

    before, after = seen["toxicity"]
    model = toxicity.learn(before, labels)
    assert ids(after) == ids(toxicity.score(before, model).where(f"score < {toxicity.DECIDE_AT}"))
    before, after = seen["MinHash near-dedup"]
    firsts = near_duplicates.classes(before).where("first")
    wordless = firsts.where("NOT has_words")
    assert ids(after) == sorted([*ids(firsts.where("has_words").select("doc_id").distinct()), *ids(wordless)])
    before, after = seen["benchmark decontamination"]
    assert ids(after) == ids(decontaminate.contamination(before, items).where("NOT contaminated"))
    before, after = seen["secret scans"]
    assert ids(after) == ids(before) and secret_scan.secrets(after).where("size(base) > 0").isEmpty()
    before, after = seen["byte-level BPE"]
    ranks = byte_pairs.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in before.select("doc_id", "text").collect()}
    for row in after.collect():
        wanted = np.array(library.encode_ordinary(texts[row.doc_id]), "<u4").tobytes()
        assert row.ids == wanted and row.n_tokens * 4 == len(wanted)
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_run_equals_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).persist()
    assert spark_rows(corpus_pipeline.run(spark, SF)) == spark_rows(docs)


def test_empty_documents(spark, tmp_path):
    docs = clashing(empty(spark))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_registered_queries_with_sql(spark):
    for name, sql in queries.SQL.items():
        names, rows = spark_rows(driver.queries()[name](spark, SF))
        assert (names, rows) == sql_rows(SF, sql), name
