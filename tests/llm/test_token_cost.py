"""op7: what keeps its cost down: few library calls, known pieces that stay, large symbols, rows of one doc_id in many tasks."""

import random

import numpy as np
import pyarrow as pa

from hourloom.llm import common, token_files, tokens
from hourloom.llm.tokens import Encoder, vocabulary

ALPHABET = ["a", "Bc", "the", "É", "ß", "İ", "漢", "é", "̈", "\xa0", "×", "\n", "\n\n", "\t", " ", " ", " ", "  ", ",", ".", ", ", ". ", ".\n", ",\n", "'s", "-", "3", "45", "!", "(", "😀", "<", "|", "x.y", "@", "_", "!!", "\x00"]


def test_marks_and_digits_take_no_whole_call():
    e = Encoder(vocabulary("byte_bpe_50k.json"))
    texts = ["Mail ab.85@mail2.example.com, call +1 (716) 555-8176.\nORSHND!! été, 84.251.36.42", "4807614710343232"]
    want, whole, calls = [e.whole(t) for t in texts], e.whole, []
    e.whole = lambda t: calls.append(t) or whole(t)
    assert e.batch(texts) == want and not calls


def test_plain_texts_are_the_library():
    rng, e = random.Random(3), Encoder(vocabulary("byte_bpe_50k.json"))
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(1, 14))) for _ in range(8000)]
    assert [t for t, got in zip(texts, e.batch(texts), strict=True) if got != e.whole(t)] == []
    assert sum(e.plain(t) is not None for t in texts if t) > 500


def test_a_column_is_the_library(monkeypatch):
    rng, e = random.Random(5), Encoder(vocabulary("byte_bpe_50k.json"))
    texts = [rng.choice([None, "", "the İ", *["".join(rng.choices(ALPHABET, k=rng.randint(1, 14)))] * 12]) for _ in range(6000)]
    want = [e.whole(t or "") for t in texts]
    plain = [not t or e.plain(t) is not None for t in texts]
    column = pa.array(["é. x", *texts], pa.string()).slice(1)
    assert tokens._plain(column.fill_null("")).tolist() == plain and plain.count(False) > 500
    assert [x.tobytes() for x in e.column(column)] == want
    assert [x.tobytes() for x in e.column(column.cast(pa.large_string()))] == want
    monkeypatch.setattr(tokens, "LONG", 9)
    assert [x.tobytes() for x in e.column(column)] == want
    assert e.column(column[:0]) == [] and [len(x) for x in e.column(pa.array([None, ""], pa.string()))] == [0, 0]


def test_a_column_asks_for_a_piece_once():
    e, asked = Encoder(vocabulary("byte_bpe_50k.json")), []
    kind = type(e.pieces)
    e.pieces = type("Counted", (kind,), {"get": lambda self, piece: asked.append(piece) or kind.get(self, piece)})(e)
    got = e.column(pa.array(["word often, word; often word"] * 300 + [None]))
    assert {x.tobytes() for x in got[:-1]} == {e.whole("word often, word; often word")}
    assert "often" in asked and len(asked) == len(set(asked))


def test_marks_behind_a_word_take_no_pattern():
    e, text = Encoder(vocabulary("byte_bpe_50k.json")), "a wordy### b \xe9t\xe9.$$$ c don't' x'! 3## TITI!!"
    runs, calls = e._runs, []
    e._runs = lambda piece: calls.append(piece) or runs(piece)
    assert e.column(pa.array([text]))[0].tobytes() == e.whole(text)
    assert not {"wordy###", "\xe9t\xe9.$$$", "TITI!!"} & set(calls)


def test_columns_end_by_bytes():
    batch = pa.record_batch({"text": ["a" * n if n else None for n in (3, 0, 4, 20, 1, 1, 30)]})
    parts = [x.column("text").to_pylist() for x in common.columns([batch, batch[:0]], "text", 10)]
    assert [t for part in parts for t in part] == batch.column("text").to_pylist()
    assert all(sum(len(t or "") for t in part[1:]) < 10 for part in parts) and len(parts) == 4


def test_pieces_asked_for_again_stay_known():
    e, asked = Encoder(vocabulary("byte_bpe_50k.json"), 40, True), []
    piece = e.piece
    e.piece = lambda p: asked.append(p) or piece(p)
    for i in range(30):
        word = "".join(chr(97 + int(d)) for d in str(i))
        e.batch([f"often {word} {word}x {word}y"])
    assert asked.count("\x00often") == 1 and len(e.pieces) + len(e.pieces.older) <= 60


def test_symbols_too_large_to_pack():
    ids = np.tile(np.array([7, 2**31, 9, 2**31 + 5], np.uint32), 900)
    x, rules = token_files.compress(ids, 0, 2**31 + 6)
    back = x.tolist()
    while any(s >= 2**31 + 6 for s in back):
        back = [y for s in back for y in (rules[s - 2**31 - 6] if s >= 2**31 + 6 else (s,))]
    assert back == ids.tolist() and len(x) < 100


def test_rows_of_one_doc_id_are_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(None, f"text {i}") for i in range(400)]
        files = token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"))
        assert files.select("part").distinct().count() > 1
        assert token_files.read_token_files(files).count() == 400
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
