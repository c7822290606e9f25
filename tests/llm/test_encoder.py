"""The encoder against the library on fuzzed strings."""

import random

import pytest

from hourloom.llm.tokens import Encoder, vocabulary

ALPHABET = ["a", "Bc", "the", "word", "É", "ß", "İ", "ŉ", "ǰ", "漢", "ж", "é", "̈", "\xa0", "\r", "\n", "\n\n", "\t", " ", " ", " ", "  ", ",", ".", ", ", ". ", "'s", "-", "3", "45", "!", "(", "​", "😀"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_fuzz(name):
    rng, e = random.Random(7), Encoder(vocabulary(name))
    assert e.cuts
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(1, 14))) for _ in range(5000)]
    texts += ["İ, a", "İ. a", "a İ, b"]
    assert [t for t, got in zip(texts, e.batch(texts), strict=True) if got != e.whole(t)] == []
