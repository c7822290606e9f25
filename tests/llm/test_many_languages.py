"""Every labelled language can be predicted; recall over the embeddings table."""

import numpy as np

from hourloom.llm import language_id, queries

from .test_llm import docs


def test_seventy_languages_from_few_rows(spark):
    rng = np.random.default_rng(2)
    words = {f"l{i:02d}": ["".join(chr(0x4E00 + 40 * i + x) for x in rng.integers(0, 40, 3)) for _ in range(20)] for i in range(70)}
    texts = [(" ".join(rng.choice(w, 12)), lang) for lang, w in words.items() for _ in range(12)]
    d = docs(spark, [t for t, _ in texts], {i: lang for i, (_, lang) in enumerate(texts)})
    model = language_id.fit(language_id.sampled(d))
    assert model.langs == sorted(words)
    right = sum(model.predict(t)[0] == lang for t, lang in texts)
    print("right of", len(texts), right)
    assert right > 10 * len(texts) / 70


def test_recall(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect() if r.embedding and None not in r.embedding]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    got = {}
    for r in queries.op2_neighbours(spark, d).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        s = x @ x[at]
        s[at] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        hit, total = hit + len(got[ids[at]] & {*best.tolist()}), total + len(best)
    assert hit >= 0.9 * total
