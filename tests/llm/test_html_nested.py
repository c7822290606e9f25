"""Articles whose best container is only a part of them."""

import pytest

from hourloom.llm import html_text

LONG = "Long text, with commas, here. " * 9
P = f"<p>{LONG}</p>" * 4
BODY = [LONG.strip()] * 4
INNER = f"<h1>Title</h1><p>short lead</p><div class=body>{P}</div><h2>Last</h2><ul><li>one item</li></ul><p>short end</p>"
WANT = ["Title", "short lead", *BODY, "Last", "one item", "short end"]
LINKS = "<ul>" + "<li><a href=x>Some other page of the site</a></li>" * 9 + "</ul>"


@pytest.mark.parametrize("page,want", [
    (f"<article>{INNER}</article>", WANT),
    (f"<body><div>{LINKS}</div><main><h1>Over</h1><article>{INNER}</article></main><footer>f</footer>", ["Over", *WANT]),
    (f"<article><section><h2>A</h2>{P}</section><section><h2>B</h2><p>short, one</p></section></article>", ["A", *BODY, "B", "short, one"]),
    (f"<article><div><div>{P}</div><div class=share>share</div></div><p>end</p><nav>n</nav></article>", [*BODY, "end"]),
    (f"<body><div>{LINKS}</div><div>{INNER}</div>{LINKS}", WANT),
    (f"<body>{LINKS}<div><div><h2>A</h2>{P}</div><div><h2>B</h2><p>short, one</p></div>{LINKS}</div>", ["A", *BODY, "B", "short, one"]),
])
def test_nothing_of_a_nested_article_is_lost(page, want):
    assert html_text.main_text(page).split("\n") == want
