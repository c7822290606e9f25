"""Every link is counted: n_links against brute force, in groups of one block and of several."""

import pytest

from hourloom.llm import jaccard_join

from .test_jaccard_groups import near_copies
from .test_llm import brute_components, docs


def brute_links(texts):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    shared = lambda a, b: len(a & b)
    return [sum(i != j and bool(a) and 4 * shared(a, b) >= 3 * (len(a) + len(b) - shared(a, b)) for j, b in enumerate(sets)) for i, a in enumerate(sets)]


@pytest.mark.parametrize("block,hot", [(1024, 100_000), (24, 100_000), (24, 10)])
def test_every_link_is_counted(spark, block, hot):
    texts = near_copies(120, block + hot)
    texts += texts[:20] + ["", None, "one", "one"]
    d = docs(spark, texts).repartition(5)
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(d, block=block, hot=hot).collect()}
    want = brute_links(texts)
    assert [got[i].n_links for i in range(len(texts))] == want and max(want) > 20
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == brute_components(texts)
    plain = jaccard_join.jaccard_components(d, block=block, hot=hot, counts=False).collect()
    assert {r.doc_id: r.component_id for r in plain} == {i: r.component_id for i, r in got.items()}
