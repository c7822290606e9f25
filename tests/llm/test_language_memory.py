"""The driver's memory while the language model is fitted grows with the subwords of the sample, not with all buckets."""

import tracemalloc

import numpy as np

from hourloom.llm import language_id


def test_the_sample_is_never_opened_whole():
    rng = np.random.default_rng(1)
    words = {lang: [f"{lang}{x}" for x in rng.integers(0, 500, 300)] for lang in ("ab", "cd")}
    rows = [(np.frombuffer(language_id._packed(language_id.subword_counts(" ".join(rng.choice(words[lang], 20)))), np.uint32), lang) for lang in words for _ in range(1500)]
    tracemalloc.start()
    model = language_id.fit(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3000 * language_id.BUCKETS * 4  # bytes of the sample's counts over all buckets
    assert model.predict(" ".join(words["cd"][:20]))[0] == "cd"
