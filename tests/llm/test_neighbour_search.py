"""op2's search of one block: many queries at once, nothing farther than what is known, scores of pairs alone."""

import time

import numpy as np

from hourloom.llm import neighbours


def block(rows: int, queries: int, seed: int = 4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 64))
    q, most2 = x[:: rows // queries], float((x * x).sum(1).max())
    g = neighbours.directions(64)
    px = np.c_[x, np.sqrt(np.maximum(most2 - (x * x).sum(1), 0))] @ g
    return x, px, np.arange(rows) * 3, q, np.c_[q, np.zeros(len(q))] @ g, most2


def test_many_queries_take_few_products():
    x, px, ids, q, pq, most2 = block(16_384, 800)
    began = time.thread_time()
    who, found, score = neighbours.search(x, px, ids, q, pq, np.full(len(q), np.inf), 21, most2, neighbours.chi_square_quantile(neighbours.CONFIDENCE, neighbours.M))
    assert time.thread_time() - began < 6  # query by query and leaf by leaf: 17 s
    full, hit = q @ x.T, 0
    for i in range(len(q)):
        mine = found[who == i]
        assert len(mine) == 21 and np.allclose(full[i, mine // 3], score[who == i])
        hit += len({*mine.tolist()} & {*(3 * np.argsort(-full[i])[:21]).tolist()})
    assert hit >= 0.9 * 21 * len(q)


def test_nothing_beyond_the_known_distance_and_scores_of_pairs_alone():
    x, px, ids, q, pq, most2 = block(3000, 60)
    known = np.sort(q @ x.T, axis=1)[:, -5]
    kth = (q * q).sum(1) + most2 - 2 * known
    who, found, score = neighbours.search(x, px, ids, q, pq, kth, 21, most2, 1e9)
    assert np.bincount(who, minlength=len(q)).tolist() == [5] * len(q) and (score >= known[who] - 1e-6).all()
    alone = neighbours.search(x, px, ids, q[7:8], pq[7:8], kth[7:8], 21, most2, 1e9)
    assert {*zip(alone[1].tolist(), alone[2].tolist(), strict=True)} == {*zip(found[who == 7].tolist(), score[who == 7].tolist(), strict=True)}


def test_fewer_rows_than_k_and_ties():
    x = np.tile(np.eye(64)[:3], (2, 1))
    x, ids, g = np.r_[x, [x[0]]], np.array([9, 8, 7, 6, 5, 4, 3]), neighbours.directions(64)
    most2, q = 1.0, np.eye(64)[:1]
    px, pq = np.c_[x, np.zeros(7)] @ g, np.c_[q, np.zeros(1)] @ g
    assert {*neighbours.search(x, px, ids, q, pq, np.array([np.inf]), 21, most2, 15.5)[1].tolist()} == {*ids.tolist()}
    assert sorted(neighbours.search(x, px, ids, q, pq, np.array([np.inf]), 2, most2, 15.5)[1].tolist()) == [3, 6]
