"""Rejected and kept languages, letters, and the bound on the sample; archives full of magic."""

import time

import numpy as np
import pytest

from hourloom.llm import language_id, warc


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language_id.fit(language_id.sampled(docs.where(~language_id.held_out_column()).select("doc_id", "text", "lang")))


@pytest.mark.parametrize("text", ["Все счастливые семьи похожи друг на друга, каждая несчастливая семья", "私は猫である。名前はまだない。どこで生れたか", "kbrtz xqvw pltrk zzrgh qwxk vbnm trplk", "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan", "0x3f9aab27 ffee0011 aGVsbG8gd29ybGQ= Zm9vYmFyYmF6 cXV4cXV1eA=="])
def test_foreign_texts_are_rejected(model, text):
    assert model.predict(text)[2]


def test_letters_are_of_category_l(model):
    for text in ("²", "½ Ⅷ ٣", "12 _ -", "", None):
        assert model.predict(text) == ("und", 0.0, True)


def test_known_texts_are_kept(docs, model):
    held = docs.where(language_id.held_out_column()).where("text is not null and lang is not null").collect()
    kept = [not model.predict(r.text)[2] for r in held if language_id.has_letter(r.text)]
    assert np.mean(kept) >= 0.99
    noise = "ana.42@mail7.example.com 4111 1111 1111 1111 +1 (269) 555-3296 27.65.93.188 "
    long = [r.text for r in held if len(r.text) > 200][:50]
    assert not any(model.predict(noise * 3 + t)[2] for t in long)


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_ROWS", 40)
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text of ', id) AS text", "concat('l', id % 100) AS lang")
    rows = language_id.sampled(docs)
    assert len(rows) == 40 and len({lang for _, lang in rows}) == 20


@pytest.mark.parametrize("piece", [b"WARC/1.0\r\n", b"WARC/1.0\r\nA: WARC/1.0\r\n", b"WARC/1.0\r\nWARC-Type: response\r\n\r\n"])
def test_magic_in_payloads_is_read_in_linear_time(spark, piece):
    page = (piece * (2_000_000 // len(piece))).decode()
    pages = spark.createDataFrame([(1, "u", page), (2, "v", "x"), (3, "w", page + "\r\n\r\n")], "page_id long, url string, html string")
    began = time.time()
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type) for r in warc.round_trip(pages).collect()}
    assert got == {i: (len(p.encode()), warc.digest(p.encode()), "response") for i, _, p in pages.collect()}
    assert time.time() - began < 60
