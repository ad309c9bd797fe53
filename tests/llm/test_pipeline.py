"""The queries as they are registered, and the pipeline as a whole."""

import zlib

import corpus_pipeline
from tallyward.llm import queries

SF = "/root/testdata/sf0.01"


def test_queries_cover_their_tables(spark):
    docs = {r["doc_id"]: r["text"] for r in queries.table(spark, SF, "documents").collect()}
    for name in ("op1_bpe", "op3_minhash_dedup", "op4_licenses", "op6_suffix_tree", "op8_toxicity", "op9_perplexity"):
        rows = queries.QUERIES[name](spark, SF).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(docs), name
        if name in ("op6_suffix_tree", "op8_toxicity"):
            n, k = (7, 2) if name == "op6_suffix_tree" else (3, 1)
            assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == k) for r in rows)


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.cut(stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        kept = {r["doc_id"]: r for r in after.collect()}
        assert kept and all(before[i] == r for i, r in kept.items()) and len(kept) < len(before), name
        assert stage(spark, docs.limit(0), SF).collect() == []
        docs, before = after, kept
    encoded = queries.QUERIES["pipeline"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in encoded) == sorted(before) and all(r["n_tokens"] > 0 for r in encoded)
