"""Near-copy groups of several blocks and hot tokens against brute force."""

import numpy as np
import pytest

from hourloom.llm import jaccard_join

from .test_llm import brute_components, docs


def near_copies(n, seed):
    """Copies of one text with 0 to 4 words replaced (0.75 is crossed between them), and texts that share a passage."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(n):
        words = list(base)
        for at in rng.choice(60, i % 5, replace=False):
            words[at] = f"x{rng.integers(1_000_000)}"
        texts.append(" ".join(words))
    texts += [" ".join([f"y{x}" for x in rng.integers(0, 9999, 6)] + base[:12]) for _ in range(n // 4)]
    return texts


@pytest.mark.parametrize("block,hot", [(1024, 100_000), (24, 100_000), (24, 10)])
def test_large_group(spark, block, hot):
    texts = near_copies(160, block + hot)
    got = jaccard_join.jaccard_components(docs(spark, texts).repartition(5), block=block, hot=hot).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)
