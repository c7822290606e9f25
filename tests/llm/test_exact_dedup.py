"""Exact duplicates: equal to grouping by text, with digests that clash, over later files, and on odd rows."""

import tempfile

import pytest
from pyspark.sql import functions as F

from hourloom.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, id string, file string, digest string, keep string, n int"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def write(spark, path, rows, mode="append"):
    spark.createDataFrame([(i, t, "a", "b", "c", "d", 1) for i, t in rows], SCHEMA).repartition(2).write.mode(mode).parquet(path)


def want(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    top = lambda g: max((x for x in g if x is not None), default=None)
    return sorted(((i, top(groups[lower(t)]), len(groups[lower(t)])) for i, t in rows), key=repr)


ROWS = [(1, "Same"), (2, "sAME"), (3, "same "), (4, "ÄB"), (5, "äb"), (6, None), (7, ""), (None, "same"), (9, "x" * 300_000), (10, "X" * 300_000), (11, "a"), (11, "a"), (None, "alone"), (12, "İ"), (13, "i̇")] + [(100 + k, "hot") for k in range(200)]


def check(spark, rows, got):
    assert sorted([(r.id, r.keep_id, r.group_size) for r in got], key=repr) == want(rows)
    texts = {lower(t) for _, t in rows}
    assert sum(r.kept for r in got) == len(texts)
    assert all(r.kept <= (r.id == r.keep_id) for r in got if r.id is not None)


@pytest.mark.parametrize("letters", [64, 1])
def test_equal_to_grouping_by_text(spark, letters):
    path = tempfile.mkdtemp(prefix="spark-") + "/docs"
    write(spark, path, ROWS)
    short = lambda t: F.substring(F.sha2(t, 256), 1, letters)  # noqa: E731  one letter: texts clash, bytes tell them apart
    check(spark, ROWS, ed.duplicates(spark, path, digest=short).collect())


def test_later_files_meet_the_state(spark):
    top = tempfile.mkdtemp(prefix="spark-")
    path, root = f"{top}/docs", f"{top}/state"
    write(spark, path, ROWS)
    ed.duplicates(spark, path, root)
    more = [(500, "SAME"), (501, "new"), (502, "hot")]
    write(spark, path, more)
    check(spark, ROWS + more, ed.duplicates(spark, path, root).collect())
    assert ed.state(spark, root).agg(F.sum("n")).first()[0] == len(ROWS) + len(more)  # older files were not read again
    assert not ed.observe(ed.stored(spark, path)[0], root)
    kept = ed.distinct_rows(spark.read.parquet(path), ed.state(spark, root))
    assert kept.columns == spark.read.parquet(path).columns and kept.count() == len({lower(t) for _, t in ROWS + more})


def test_empty(spark):
    path = tempfile.mkdtemp(prefix="spark-") + "/docs"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert ed.duplicates(spark, path).collect() == []
