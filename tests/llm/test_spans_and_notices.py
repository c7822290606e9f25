"""op1's spans against the contract's plain patterns over a whole table, patterns that found values bring in, and licence
notices that are wrapped or that the templates do not hold word by word."""

import re
import textwrap

from hourloom.llm import licenses, pii

from .test_llm import docs

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _holds(kind: str, found: str) -> bool:
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "ip":
        return all(int(x) <= 255 for x in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text: str) -> str:
    return ",".join(f"{kind}:{m.start()}:{m.end()}" for kind, p in PLAIN.items() for m in p.finditer(text) if _holds(kind, m[0]))


def test_base_spans_are_those_of_the_plain_patterns(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text]
    made = ["a@b.c@d.e.f x@y z@@q.r", "1.2.3.4.5.6.7.8 01.002.3.255 1.2.3.256", "4111-1111 1111 1111 0 4111111111111111", "+1 (319) 555-5132. +44", "é@b.co +٣12345678 ١.1.1.1"]
    assert all(pii._told(pii.base_spans(t)) == plain_spans(t) for t in texts + made)
    assert sum(bool(plain_spans(t)) for t in texts) > 10


def test_found_values_bring_in_patterns(spark):
    seeds = [f"n {i} write to u{i}@m{i}.example.org for help now" for i in range(100)]
    found = [f"n {i} write to person{i}(at)corp for help now" for i in range(10)]
    again = [f"xx {i} the badge person{i}(at)corp opens doors today" for i in range(10)]
    new = ["yy 1 the badge stranger77(at)corp opens doors today"]
    other = [f"zz {i} a parcel part{i}(at)shelf weighs little today" for i in range(10)]
    rows = {r.doc_id: r.n_discovered for r in pii.find_pii(docs(spark, seeds + found + again + new + other)).collect()}
    assert all(rows[i] == 0 for i in range(100)) and all(rows[i] == 1 for i in range(100, 121)) and all(rows[i] == 0 for i in range(121, 131))


def test_contexts_are_whole_words():
    long = "w" * 300
    assert pii._around(f"{long} abc x1 def {long}", 305, 307) == ["abc _ def"]
    assert pii._around("aa bb x1 cc dd", 6, 8) == ["aa bb _", "_ cc dd", "bb _ cc"]


def test_wrapped_notices(spark):
    mit = textwrap.fill(licenses.TEMPLATES["mit"][2], 76)
    texts = [
        f"Some words of prose.\n\n{mit}",
        "\n".join("# " + x for x in mit.split("\n")),
        "code = 1\n// Licensed under the Apache License, Version 2.0 (the \"License\"); you may\n// not use this file except in compliance with the License. You may obtain a\n// copy of the License at",
        "A line of prose of no more than seventy characters, which is wrapped here\nand goes on.\nReleased under the LGPL.",
        "The general public may read the notice in the library before the doors open\nand the owner is free to copy the list.",
        None, "",
    ]
    got = {r.doc_id: (r.licence, r.paragraph, r.n_paragraphs) for r in licenses.scan_licences(docs(spark, texts)).collect()}
    assert got == {0: ("mit", 2, 1), 1: ("mit", 0, 1), 2: ("apache-2.0", 1, 1), 3: ("lgpl", 1, 1), 4: ("none", None, 0), 5: ("none", None, 0), 6: ("none", None, 0)}


def test_notices_that_are_no_templates(spark):
    texts = {
        "This software is released under the MIT License, see the file LICENSE.": "mit", "Licensed under the Apache License 2.0; see the notice.": "apache-2.0",
        "You can redistribute it under the terms of the GNU General Public License version 2.": "gpl", "This article is licensed under CC BY-SA 4.0.": "cc-by",
        "The text is available under a Creative Commons Attribution-NonCommercial 4.0 International License.": "cc-by-nc", "This file is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2.0",
    }
    got = [r.licence for r in licenses.scan_licences(docs(spark, list(texts))).orderBy("doc_id").collect()]
    assert sum(a == b for a, b in zip(got, texts.values(), strict=True)) >= 5 and not {"public-domain", "proprietary", "none"} & set(got), got
