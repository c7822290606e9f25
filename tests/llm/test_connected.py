"""Components: right labels on any graph, and few rounds on long paths."""

import random

import pytest

from hourloom.llm import common, jaccard_join


def plain(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def rounds(monkeypatch, run):
    paths, real = [], common.written
    monkeypatch.setattr(common, "written", lambda df, path, *a: (paths.append(path), real(df, path, *a))[1])
    out = run()
    return out, sum("/labels" in p for p in paths)


@pytest.mark.parametrize("kind", ["path", "shuffled path", "random", "star and loops"])
def test_labels(spark, monkeypatch, kind):
    rnd = random.Random(4)
    names = list(range(300))
    if kind != "path":
        rnd.shuffle(names)
    edges = list(zip(names, names[1:]))
    if kind == "random":
        edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)]
    if kind == "star and loops":
        edges = [(9, x) for x in names] + [(5, 5), (1000, 1000)]
    got, n = rounds(monkeypatch, lambda: {r.node: r.label for r in common.connected(spark.createDataFrame(edges, "a long, b long")).collect()})
    assert got == plain(edges) and n <= 15


def test_a_chain_of_documents(spark, monkeypatch):
    """Each document shares most shingles with the next only; the chain is one component, found in few rounds."""
    words = [f"w{i}" for i in range(8 * 300 + 92)]
    docs = spark.createDataFrame([(1000 - k, " ".join(words[8 * k : 8 * k + 92])) for k in range(300)], "doc_id long, text string")
    got, n = rounds(monkeypatch, lambda: jaccard_join.jaccard_components(docs).collect())
    assert {r.component_id for r in got} == {701} and n <= 15
