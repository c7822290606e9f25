import time

import pytest

from hourloom.llm.html_text import main_text

BROKEN = {
    "open spans and headings": "<span><h2>x",
    "nested containers": "<div><p>some words, here",
    "tags that never end": "<a <a ",
    "declarations that never end": "<! ",
    "values that never end": "<a x='",
    "items": "<li>x",
    "cells": "<table><tr><td>",
    "headers": "<header>",
    "script ends that never end": "<script></script",
}


@pytest.mark.parametrize("piece", BROKEN.values(), ids=BROKEN.keys())
def test_time_grows_with_the_page(piece):
    began = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 20


def test_unmatched_end_tags():
    began = time.process_time()
    text = main_text("<article><p>first</p>" + "<b>" * 100_000 + "</i>" * 100_000 + "last</article>")
    assert text == "first\nlast" and time.process_time() - began < 10


def test_words_of_two_meanings_cut_links_only():
    page = "<article><p>one two.</p><p class='related-work'>Work.</p><section class='social-history'><p>Social.</p></section><h2 id='share-price'>Price</h2></article>"
    assert main_text(page) == "one two.\nWork.\nSocial.\nPrice"
    page = "<article><p>Text.</p><div class='related-work'><a href=/>one</a><a href=x/>two</a></div><div class=share-buttons>tweet</div><div class=related>more</div></article>"
    assert main_text(page) == "Text."


def test_attributes_by_the_rule_of_html():
    page = "<article><p title='the hidden = truth'>Hello</p><p data-x=it's>it's nice</p><p data-x=it's>last</p><p hidden>no</p><p style='display : none'>no</p><p aria-hidden=true>no</p></article>"
    assert main_text(page) == "Hello\nit's nice\nlast"


def test_text_that_looks_like_tags():
    assert main_text("a < b and <3 c") == "a < b and <3 c"
    assert main_text("<p>kept</p><p>cut <a href='x") == "kept\ncut <a href='x"
    assert main_text("<p>a</p><title>b</titles></title><p>c</p>") == "a\nc"


def test_equal_pages_and_ties():
    box = "<div><p>Ten words, of prose, that are the same in both boxes.</p></div>"
    page = f"<body><div>{box}{box}</div></body>"
    assert main_text(page) == main_text(page) == "\n".join(["Ten words, of prose, that are the same in both boxes."] * 2)
