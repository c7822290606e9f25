"""Revisits are decided by row."""

from hourloom.llm import warc


def test_repeated_page_id(spark):
    pages = spark.createDataFrame([(1, "u", "A"), (1, "u", "B"), (9, "u", "A"), (9, "u", "A"), (None, "u", "A")], "page_id long, url string, html string")
    got = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, "revisit", 9), (1, 1, "response", None), (9, 1, "response", None), (9, 1, "response", None), (None, 1, "response", None)], key=str)
