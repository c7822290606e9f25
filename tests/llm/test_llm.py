"""The operators of the training-data part against brute force, round trips and edge cases."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourloom.llm import decontaminate, html_text, jaccard_join, language_id, licenses, neighbours, packing, pii, queries, token_files, warc
from hourloom.llm.tokens import Encoder, vocabulary

DOC = "doc_id long, text string, lang string, source string, n_chars long, extra string, n long, fp string, score string"


def docs(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i), f"s{i % 2}", None if t is None else len(t), "x", 1, "y", "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


EDGE = [None, "", " \n\t", "one two", "a b c d e f", "a b c d e f", "mail me at x.y@site.example.org now", "word " * 30_000, "é ü 漢字", "10 20 30"]


def test_edge_rows(spark):
    d = docs(spark, EDGE).repartition(3)
    assert pii.pii_spans(d).count() == len(EDGE)
    assert packing.pack(d).select("doc_id").distinct().count() == len(EDGE)
    assert token_files.read_token_files(token_files.write_token_files(d)).count() == len(EDGE)
    assert {r.licence for r in licenses.scan_licences(d).collect()} == {"none"}
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d).collect()}
    assert by == {0: (0, 0), 1: (0, 1), 2: (0, 2), 3: (1, 3), 4: (2, 4), 5: (2, 4), 6: (1, 6), 7: (1, 7), 8: (1, 8), 9: (1, 9)}
    assert {r.lang_pred for r in language_id.language_id(d).collect()} == {"und"}
    bench = spark.createDataFrame([(1, "one two"), (2, None), (3, ""), (4, "A b, c d e f")], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(d, bench).collect()}
    assert got[0] == (0, 0, 0) and got[3] == (2, 2, 1) and got[4] == (6, 6, 1)
    blocks = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(d, bench, most_words=3).collect()}
    assert blocks == got


def test_empty_tables(spark):
    d = docs(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    for out in (pii.pii_spans(d), packing.pack(d), token_files.read_token_files(token_files.write_token_files(d)), licenses.scan_licences(d), jaccard_join.jaccard_components(d), language_id.language_id(d), decontaminate.contamination(d, bench)):
        assert out.count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 0 and warc.round_trip(pages).count() == 0
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def brute_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[j : j + 5]) for j in range(len(w) - 4)])
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_jaccard_components(spark):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 500, rng.integers(3, 60))]
        for k in range(6):  # chains of near copies
            base = list(base)
            for _ in range(k % 3):
                base[rng.integers(len(base))] = f"W{rng.integers(500)}"
            texts.append(" ".join(base))
    common = " ".join(f"c{i}" for i in range(12))
    texts += [f"{common} " + " ".join(f"w{x}" for x in rng.integers(0, 10_000, 12)) for _ in range(60)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs(spark, texts).repartition(4)).collect()}
    assert got == brute_components(texts)


def test_pii_discovers_by_context(spark):
    seeds = [f"ticket {i}: reach agent line user{i}@mail{i}.example.com before noon today" for i in range(12)]
    plain = [f"lot {i} the box weighs item{i}kg and more" for i in range(12)]
    hidden = ["ticket 99: reach agent line jdoe77(at)corp before noon today"]
    rows = {r.doc_id: r for r in pii.find_pii(docs(spark, seeds + plain + hidden)).collect()}
    text = hidden[0]
    at = text.index("jdoe77")
    assert rows[24].spans == f"email:{at}:{at + len('jdoe77(at)corp')}" and rows[24].n_discovered == 1
    assert all(rows[i].spans == "" for i in range(12, 24))
    joined = {r.doc_id: r.spans for r in pii.find_pii(docs(spark, seeds + plain + hidden), most_patterns=0).collect()}
    assert joined == {i: r.spans for i, r in rows.items()}
    out = {r.doc_id: r.text for r in pii.redact(docs(spark, seeds + hidden)).collect()}
    assert out[0] == "ticket 0: reach agent line [EMAIL] before noon today"


@pytest.mark.parametrize("text,want", [
    ("4111 1111 1111 1111", "card:0:19"), ("4111 1111 1111 1112", ""), ("1.2.3.4.5.6.7.256 1.2.3.999", "ip:0:7"), ("+1 (319) 555-5132 x", "phone:0:17"),
    ("a@b.c@d.e", "email:0:5"), ("9" * 50_000, ""),
])
def test_base_spans(text, want):
    assert pii._told(pii.base_spans(text)) == want


def test_language_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in d.select("doc_id", "lang").collect()}
    held = [r for r in language_id.language_id(d).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in held) <= 0.01 * len(held)


def test_decontamination_spans(spark):
    item = "The quick brown fox jumps over the lazy dog and then sleeps"
    text = f"Intro words here. {item.upper()}! Tail words."
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    d = docs(spark, [text, "clean text"])
    assert [r.doc_id for r in decontaminate.decontaminate(d, bench).collect()] == [1]
    assert decontaminate.decontaminate(d, bench, "spans").where("doc_id = 0").first().text == "Intro words here. ! Tail words."


def test_packing_follows_the_mixture(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(d).collect()
    total = sum(r.length for r in rows)
    share, by_seq = defaultdict(int), defaultdict(list)
    for r in rows:
        share[r.source] += r.length
        by_seq[r.sequence_id].append(r)
    for s, seq in by_seq.items():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        if s < len(by_seq) - 1:
            assert at == 2048
            for name, n in share.items():
                assert abs(sum(r.length for r in seq if r.source == name) - 2048 * n / total) <= 2
    e = Encoder(vocabulary("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in d.collect()}
    whole = {i: np.append(np.frombuffer(e.whole(t or ""), np.uint32), np.uint32(1)).astype("<u4") for i, t in text.items()}
    got = defaultdict(int)
    for r in rows:
        assert zlib.crc32(whole[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(whole[r.doc_id]) == r.doc_tokens
        got[r.doc_id] += r.length
    assert got == {i: len(x) for i, x in whole.items()}


def test_rare_sources_share_a_queue():
    sizes = [("a", 10_000), ("b", 5_000)]
    queue_of, spans = packing._queues(sizes, 15_007, 2048)
    assert sum(n for _, n in spans.values()) == 15_007
    for before, own in spans.values():
        pieces = [p for at in range(0, own, 700) for p in packing.cut(at, min(700, own - at), before, own, 15_007, 2048)]
        assert sum(p[1] for p in pieces) == own and all(p[1] > 0 for p in pieces)


def test_encoder_is_the_library(spark):
    texts = ["a  b c", " x", "\n z \n\n q", "It's don't <|endoftext|> 3.5, end.", "Élan été, ça", "", "tab\tand\x00nul", "ﬁ İ ǆ", "\r.'bar.\n日) \xa0 \xa0 ", "foo.\nBar, baz\n\nqux, 3, 4"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        e = Encoder(vocabulary(name))
        assert e.batch(texts) == [e.whole(t) for t in texts]


def test_token_files_round_trip():
    rng = np.random.default_rng(0)
    stream = [(i, np.r_[rng.zipf(1.4, 200) % 900, 0].astype(np.uint32)) for i in range(50)]
    f = token_files.TokenFile(token_files.encode_file(stream, 0))
    assert (f.all_ids() == np.concatenate([x for _, x in stream])).all() and len(f.rules)
    for i, a, b in ((3, 0, 5), (7, 100, 160), (49, 199, 201)):
        assert (f.decode_range(i, a, b) == stream[i][1][a:b]).all()


def test_warc_rejects_magic_in_payloads(spark):
    inner = warc.record("response", 999, None, 3, "x", b"abc", None).decode()
    htmls = ["<p>a</p>", None, "<p>a</p>", inner, f"x{inner}y", "", "é" * 3000]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://x/{i}\r\nEvil: 1", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages, archive_bytes=3000), segment=512).collect()}
    want = {}
    for i, h in enumerate(htmls):
        raw = (h or "").encode()
        last = max(j for j, x in enumerate(htmls) if (x or "") == (h or ""))
        want[i] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if last == i else "revisit", None if last == i else last)
    assert got == want


def test_neighbours_recall_copies_and_bad_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[::7] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (None, x[1].tolist())]
    got = defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q in range(0, 1500, 20):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        best = np.lexsort((np.arange(1500), -s))[:20]
        mine = [v for _, v, _ in sorted(got[q])]
        assert [n for n, _, _ in sorted(got[q])] == list(range(1, 21))
        hit += len({*best.tolist()} & {*mine})
        assert q % 7 or mine == best.tolist()
    assert hit >= 0.9 * 20 * 75 and {*got} == {*range(0, 1500, 20)}


def test_licences(spark):
    texts = ["Some words.\nReleased under the MIT License.", "Licensed under CC BY-NC 4.0.", "The license of the driver was public.", "intro\nAll rights reserved.\nmore of it"]
    d = docs(spark, texts + texts[:1])
    got = [(r.doc_id, r.licence, r.paragraph) for r in licenses.scan_licences(d).orderBy("doc_id").collect()]
    assert got == [(0, "mit", 1), (1, "cc-by-nc", 0), (2, "none", None), (3, "proprietary", 1), (4, "mit", 1)]


@pytest.mark.parametrize("page,want", [
    (None, ""), ("", ""), ("plain", "plain"),
    ("<body><nav><a href=x>Menu</a></nav><header><p>Site, site, site</p></header><article><h1>Title &amp; more</h1><p>First,  para<br>graph.<p>Second <b>one</b>.</article><div class='comments'><p>Me, too, yes</p></div><footer>f</footer>", "Title & more\nFirst, para graph.\nSecond one ."[:-2] + "."),
    ("<div id=main><p>" + "Long text, with commas, here. " * 9 + "</p><div class=ad>buy</div></div><script>if (a<b) x('</p>')</script>", ("Long text, with commas, here. " * 9).strip()),
])
def test_html(page, want):
    assert html_text.main_text(page) == want


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    d = spark.read.parquet(f"{sf}/documents.parquet")
    at, cols = d, d.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, sf)
        assert at.columns == cols, name
    links = jaccard_join.jaccard_components(d).where("component_id = doc_id").count()
    assert 0 < at.count() <= links
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert decontaminate.contamination(at, bench).where("contaminated").count() == 0
    found = pii.pii_spans(at).agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone"))).first()[0]
    assert found == 0


def test_sql_gives_the_same_rows(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.sql(f"create view {t} as select * from '{d}/{t}.parquet'")
    for name, sql in queries.SQL.items():
        got = queries.QUERIES[name](spark, d)
        want = con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        assert Counter(tuple(r[c] for c in want.columns) for r in got.collect()) == Counter(want.fetchall()), name
