"""Benchmark rows without an item_id."""

import pytest

from hourloom.llm import decontaminate


@pytest.mark.parametrize("most", [1000, 4])
def test_items_without_an_id_contaminate(spark, most):
    docs = spark.createDataFrame([(0, "say one two three now"), (1, "four five six"), (2, "clean words")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "one two three"), ("x", "four five six")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.contamination(docs, bench, most_words=most).collect()}
    assert got == {0: (3, 1, True), 1: (3, 1, True), 2: (0, 0, False)}
    assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == [2]
