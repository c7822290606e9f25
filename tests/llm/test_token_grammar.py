"""Re-Pair: round trips, exhaustion, runs of equal ids; the query against the library over a table."""

import zlib

import numpy as np

from hourloom.llm import queries, token_files
from hourloom.llm.tokens import Encoder, vocabulary


def back(x, rules, first):
    return token_files.expand(x, np.array(rules, np.uint32).reshape(-1, 2), first)


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(0)
    for _ in range(200):
        ids = rng.integers(0, rng.integers(2, 6), rng.integers(0, 900)).astype(np.uint32)
        x, rules = token_files.compress(ids, 0, 10)
        assert (back(x, rules, 10) == ids).all()
        inner = (x[:-1] != 0) & (x[1:] != 0) & (x[:-1] != x[1:]) if len(x) > 1 else np.zeros(0, bool)
        if inner.any():
            assert np.unique(x[:-1][inner].astype(np.int64) << 32 | x[1:][inner], return_counts=True)[1].max() < token_files.LEAST


def test_runs_and_periods():
    for ids in (np.full(30_000, 5, np.uint32), np.tile(np.array([3, 4, 5, 6, 7], np.uint32), 3000)):
        x, rules = token_files.compress(ids, 0, 10)
        assert (back(x, rules, 10) == ids).all() and len(x) < 40


def test_query_is_the_library(spark):
    d = "/root/testdata/sf0.001"
    e, at, want = Encoder(vocabulary("byte_bpe_50k.json")), 0, {}
    for r in spark.read.parquet(f"{d}/documents.parquet").orderBy("doc_id").collect():
        ids = e.whole(r.text or "") + bytes(4)
        want[r.doc_id] = (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op7_token_files(spark, d).collect()} == want
