"""Centroid rounds against plain numpy in Python integers; dictionaries lose nothing."""

import hashlib
import math

import numpy as np
import pytest

from hourloom.llm import centroids as ce

SCHEMA = "vec_id long, embedding array<float>, id string, v int, cluster string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, "y") for i, v in rows], SCHEMA)


def brute(rows, k, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    cs = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        mine = {}
        for _, v in kept:
            mine.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(mine[j]) for x in zip(*mine[j])] if j in mine else c for j, c in enumerate(cs)]
    return sorted([(i, near(v)[1], near(v)[0]) for i, v in kept], key=repr), cs


def some_rows():
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(0, 0.12, 64).tolist()) for i in range(150)]
    rows += [(7, rows[7][1])] * 30 + [(None, rows[3][1]), (200, None), (201, [0.1] * 63), (202, [0.1] * 63 + [None]), (203, [0.1] * 63 + [float("nan")]), (204, [float("inf")] + [0.0] * 63), (205, [0.0] * 64), (206, [])]
    return rows


@pytest.mark.parametrize("width, chunk", [(2, 8192), (1, 16), (3, 50)])
def test_against_brute_force(spark, width, chunk):
    rows = some_rows()
    got, cs = ce.cluster(table(spark, rows).repartition(3), k=12, width=width, chunk=chunk)
    want, want_cs = brute(rows, 12)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want and cs.tolist() == want_cs


def test_few_none_and_too_large(spark):
    rows = some_rows()[:3]
    got, cs = ce.cluster(table(spark, rows), k=40)
    assert len(cs) == 3 and got.count() == 3 and ce.described(got, cs).count() == 3
    for empty in ([], [(1, None)]):
        got, cs = ce.cluster(table(spark, empty), k=40)
        assert got.collect() == [] and ce.described(got, cs).collect() == []
    with pytest.raises(Exception, match="after scaling"):
        ce.cluster(table(spark, [(1, [1e9] * 64)]), k=1)[0].collect()


def test_dictionaries_lose_nothing():
    x = np.random.default_rng(1).integers(-300, 300, (500, 5))
    (ids, blocks) = next(ce._chunks([ce._encoded(list(range(500)), x, 2)]))
    assert ids == list(range(500)) and [len(d) for d, _ in blocks] == [len(np.unique(x[:, lo : lo + 2], axis=0)) for lo in (0, 2, 4)]
    assert (np.hstack([d[c] for d, c in blocks]) == x).all()
