"""Given mixtures: every id once, full windows, proportions while the sources last."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest

from hourloom.llm import packing


def windows(weights, sizes, length):
    """Ids of each source in each window, from the stretches, each place of each source once."""
    stretches, end = packing._stretches(weights, sizes, length)
    assert end == sum(sizes.get(s, 0) for s in weights)
    taken, of = defaultdict(set), defaultdict(lambda: defaultdict(int))
    for s, mine in stretches.items():
        place = 0
        while place < sizes.get(s, 0):
            n = min(random.Random(place).randint(1, 9), sizes[s] - place)
            got = packing.pieces(place, n, mine, length)
            assert [x[0] for x in got] == [sum(y[1] for y in got[:i]) for i in range(len(got))] and sum(x[1] for x in got) == n
            for _, size, w, offset in got:
                of[w][s] += size
                for o in range(offset, offset + size):
                    assert o not in taken[w]
                    taken[w].add(o)
            place += n
    assert all(taken[w] == set(range(length)) for w in range(end // length))
    assert end % length == 0 or taken[end // length] == set(range(end % length))
    return of


@pytest.mark.parametrize("seed", range(40))
def test_every_place_once(seed):
    r = random.Random(seed)
    sizes = {s: r.randint(0, 400) for s in "abcde"[: r.randint(1, 5)]}
    windows({s: r.choice([0.5, 1, 2, 7.5]) for s in [*sizes, "missing"]}, sizes, r.randint(150, 200))
    windows({s: r.choice([1, 1.5, 2]) for s in [*sizes, "missing"]}, sizes, r.randint(24, 30))


def test_proportions_hold_until_a_source_runs_dry():
    of = windows({"a": 3, "b": 1, "c": 1}, {"a": 3000, "b": 200, "c": 5000}, 100)
    for w in range(10):  # b lasts for 1000 ids
        assert abs(of[w]["a"] - 60) <= 1 and abs(of[w]["b"] - 20) <= 1 and abs(of[w]["c"] - 20) <= 1
    for w in range(10, 42):  # then a and c by 3 to 1, until a is dry after 3200 more
        assert of[w]["b"] == 0 and abs(of[w]["a"] - 75) <= 1
    assert all(of[w] == {"c": 100} for w in range(42, 82))
    for w in range(10):  # deficits are carried: never off by more than an id in all
        assert abs(sum(of[v]["a"] for v in range(w + 1)) - Fraction(3, 5) * 100 * (w + 1)) <= 1


def test_whole_table(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7 + 1), s) for i, s in enumerate(["a", "b", "c", None] * 30)], "doc_id long, text string, source string")
    rows = packing.pack(docs, length=16, mixture={"a": 1, "b": 3}).collect()
    taken = defaultdict(list)
    for r in rows:
        taken[r.sequence_id] += range(r.offset, r.offset + r.length)
    last = max(taken)
    assert all(sorted(x) == list(range(16 if w < last else len(x))) for w, x in taken.items())
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(map(len, taken.values())) == sum(tokens.values()) and len(tokens) == 120
    named = sum(n for i, n in tokens.items() if i % 4 < 2)
    assert all((r.source in ("a", "b")) == (r.sequence_id * 16 + r.offset < named) for r in rows)
    first = [r for r in rows if r.sequence_id < 8]
    assert sum(r.length for r in first if r.source == "b") == 96


@pytest.mark.parametrize("mixture", [{}, {"a": 0}, {"a": -1}, {"a": 1, "b": 2000}])
def test_weights_above_zero(spark, mixture):
    docs = spark.createDataFrame([(1, "x", "a")], "doc_id long, text string, source string")
    with pytest.raises(ValueError):
        packing.pack(docs, mixture=mixture)


def test_table_without_source(spark):
    rows = packing.pack(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.offset, r.source) for r in rows)[0] == (1, 0, None) and len(rows) == 2
