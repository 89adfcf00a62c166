"""Main text of made-up pages of several layouts, and the query against its SQL."""

import pytest

from lanewright.llm import html as op
from lanewright.llm import queries
from tests.compare import differences
from tests.llm.tables import duck

LONG = "A sentence of an article that goes on for quite a while, as sentences of articles do. " * 3
LONG = LONG.strip()
NOISE = (
    "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News and more</a></li></ul></nav><header><h2>The Site</h2></header>"
    "<div class='ad-box'>Buy this now, it is cheap and good and you will never need another one of these things again.</div>"
    "<aside>Read also: another story about something else entirely, which is long enough to look like text.</aside>"
    "<div id='cookieNotice'>We use cookies to make this site work as well as it can for all of its readers.</div>"
    "<form><label>Mail</label><input name=m><button>Send</button></form><script>var x = '</p>' + 1 < 2;</script>"
)
COMMENTS = "<section class='comments'><p>First! I do not agree with any of this, and I will tell you at length why that is so.</p></section>"
FOOT = "<footer>&copy; The Site</footer>"


@pytest.mark.parametrize("wrap", [
    "<article>{}</article>", "<main><div>{}</div></main>", "<div id=content><div class=post>{}</div></div>",
    "<main><article>{}</article></main>", "<table><tr><td>{}</td></tr></table>",
])
def test_layouts(wrap):
    body = f"<h1>The title</h1><p>{LONG}<p><b>Short.</b></p><ul><li>one<li>two</ul><blockquote>{LONG}</blockquote><p>End&nbsp;&amp; &lt;done&gt;."
    page = f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{NOISE}{wrap.format(body)}{COMMENTS}{FOOT}</body></html>"
    assert op.main_text(page) == f"The title {LONG} Short. one two {LONG} End & <done>."


@pytest.mark.parametrize("page,text", [
    ("", ""), ("   \n", ""), ("plain text only", "plain text only"), ("<p>a<b>b</b>c<br>d", "abc d"),
    ("<article></article>", ""), ("<script>x", ""), ("<article><p>x &am</p><p>&#65;&bogus; y", "x &am A&bogus; y"),
    ("<nav>only a menu</nav>", ""), ("<article><p>one\n\t two<!-- no --> three</p></article>", "one two three"),
    ("<article><header><h1>Head</h1></header><p>Body</p></article>", "Head Body"),
])
def test_small_pages(page, text):
    assert op.main_text(page) == text


def test_short_article_beside_long_noise():
    page = f"<body>{NOISE}<article><h1>No.</h1><p>No.</p></article>{COMMENTS}{FOOT}"
    assert op.main_text(page) == "No. No."


@pytest.mark.parametrize("wrap", ["<div><div>{}{}</div><div>{}</div></div>", "<div><p>{}</p><ul><li>{}</ul><section>{}</section></div>", "<table><tr><td>{}{}<td>{}</table>"])
def test_content_split_over_blocks(wrap):
    """Without an article or main element, all blocks with content are main text, whatever their shares."""
    page = f"<body>{NOISE}{wrap.format(*(f'<p>{x} {LONG}</p>' for x in 'abc'))}{COMMENTS}{FOOT}"
    assert op.main_text(page) == f"a {LONG} b {LONG} c {LONG}"


def test_deep_and_long_pages():
    assert op.main_text("<div>" * 3000 + "x") == "x"
    assert op.main_text("<p>word</p>" * 20_000).count("word") == 20_000


def test_frames(spark):
    rows = [(1, "<article>x</article>", "u"), (1, "<article>x</article>", "u"), (2, None, None), (None, "", "v")]
    pages = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    got = op.extract(pages)
    assert got.columns == ["page_id", "n_chars", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", "x"), (1, "u", "x"), (2, None, ""), (None, "v", "")], key=str)
    assert op.extract(pages.limit(0)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    found = differences(queries.op5_html(spark, sf), duck(sf), queries.SQL["op5_html"])
    assert not found, "\n".join(found)
