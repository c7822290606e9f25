"""Columns of the user whose names are those of the operators' verdicts survive every stage."""

import pytest

import corpus_pipeline
from hourloom.llm import decontaminate, language_id, pii

NAMES = {"items": "string", "score": "string", "spans": "long", "n_words": "string", "rejected": "string", "n_email": "string", "hit_lo": "long", "lang_pred": "long", "_row": "string", "_key": "string", "n_discovered": "string", "component_id": "string", "fp": "long"}


@pytest.fixture()
def own(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, kind in NAMES.items():
        rows = rows.withColumn(name, rows.doc_id.cast(kind))
    return rows


def held(out, of):
    assert out.dtypes == of.dtypes
    rows = out.collect()
    assert rows and all(str(r[n]) == str(r.doc_id) for r in rows for n in NAMES)
    return {r.doc_id: r.text for r in rows}


def test_stages(spark, own):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held(stage(spark, own, "/root/testdata/sf0.001"), own)


def test_other_branches(spark, own):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    for mode in ("documents", "spans"):
        assert held(decontaminate.decontaminate(own, bench, mode, most_words=500), own) == held(decontaminate.decontaminate(own, bench, mode), own)
    assert held(pii.redact(own, most_patterns=-1), own) == held(pii.redact(own), own)
    held(language_id.drop_rejected(own), own)
