import os
from html.parser import HTMLParser

import pytest

from sensorlake.llm.catalog import op11_main_text
from sensorlake.llm.htmltext import Rules, classify, extract_main_text, main_text

FOLDER = "/root/testdata/sf0.01"
LONG = "The house by the sea is one of the oldest of the town and it is open to all that come by on a day in spring."
OTHER = "It was a day of rain and of wind, and for that the men in the boats were not on the water but at home with us."


class Article(HTMLParser):
    """Text of the article element, block by block, by the library's own parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "article":
            self.inside = False
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def plain_reading(page):
    parser = Article()
    parser.feed(page or "")
    parser.close()
    return " ".join(" ".join(b.split()) for b in parser.blocks if b.split())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
def test_whole_table_against_a_plain_reading(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = op11_main_text(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        want = plain_reading(pages[r.page_id].html)
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
def test_whole_table_without_the_article_tag(spark):
    """Menus, adverts and footers are still told from the text by the two passes."""
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        page = r.html.replace("<article>", "<div>").replace("</article>", "</div>")
        assert main_text(page) == plain_reading(r.html)


def page(body, head="<title>Words of the title</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


MENU = '<ul><li><a href="/a">Home of the town</a><li><a href="/b">All the news and the rest</a></ul>'


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), (" \n", ""), ("Just a &lt; b", "Just a < b"), ("<p>Short.", "Short."),
    (page(f"<p>{LONG}</p>"), LONG),
    # the first pass: link density, length and stop words
    (page(f"<div>{MENU}</div><div><h2>Head</h2><p>{LONG}</p><p>End.</p></div>"), f"Head {LONG} End."),
    (page(f"<div><p>{LONG}</p></div><div><a href='x'>{OTHER}</a></div>"), LONG),
    (page("<p>" + "zq xw vk " * 30 + f"</p><p>{LONG}</p>"), "zq xw vk " * 29 + f"zq xw vk {LONG}"),
    # the second pass: short blocks between others
    (page(f"<div><p>{LONG}</p><p>Yes.</p><p>{OTHER}</p></div>"), f"{LONG} Yes. {OTHER}"),
    (page(f"{MENU}<div>Today</div>{MENU}<p>{LONG}</p>"), LONG),
    # zones
    (page(f"<header><p>{OTHER}</p></header><nav>{MENU}</nav><article><h1>A b</h1><p>{LONG}</article><footer>{OTHER}"),
     f"A b {LONG}"),
    (page(f"<article><header><h1>Name</h1></header><p>{LONG}</p><footer>By us</footer></article>"), f"Name {LONG}"),
    (page(f"<article><p>{LONG}</p><section class='comments'><p>{OTHER}</p></section></article>"), LONG),
    (page(f"<article><p>{LONG}</p></article><article class='comment'><p>{OTHER}</p></article>"), LONG),
    (page(f"<div id=commentList><p>{OTHER}</p></div><p>{LONG}</p>"), LONG),
    (page(f"<div class='cookieBanner'><p>{OTHER}</p></div><main><p>{LONG}</p></main>"), LONG),
    (page(f"<div class='has-sidebar no-ads'><p>{LONG}</p><div class='sidebar-left'>{OTHER}</div></div>"), LONG),
    (page(f"<aside><article><p>{OTHER}</p></article></aside><article><p>{LONG}</p></article>"), LONG),
    (page(f"<main><p>{OTHER}</p><article><p>{LONG}</p></article></main>"), LONG),
    (page(f"<form><div><p>{OTHER}</p><main><p>{LONG}</p></main></div></form>"), LONG),
    (page(f"<p>{LONG}</p><form>{OTHER}<textarea>{OTHER}</textarea></form><div hidden>{OTHER}</div>"), LONG),
    (page(f"<div style='display: none'><p>{OTHER}</p></div><div role=alert>{OTHER}</div><p>{LONG}</p>"), LONG),
    # scripts, styles, comments, broken and crossed tags
    (page(f"<script>var a='</p><p>{OTHER}'</script><style>p{{}}</style><noscript>{OTHER}</noscript><p>{LONG}</p>"), LONG),
    (page(f"<!-- <p>{OTHER}</p> --><p title='a > b'>{LONG}</p><![CDATA[x]]><?php y ?>"), LONG),
    (page(f"<ARTICLE><P><B>{LONG}<BR>{OTHER}<P>Auxpa."), f"{LONG} {OTHER} Auxpa."),
    (f"<article><p>{LONG}</div></p><p>{OTHER}</article", f"{LONG} {OTHER}"),
    (f"<article><p>{LONG}</p><!-- {OTHER}", LONG), (f"<article><p>{LONG}</p><script>{OTHER}", LONG),
    # references and white space
    (page(f"<p>{LONG}&nbsp;caf&eacute; &amp;amp; &#8364;&#x41; &am &quot;x\n\t y</p>"), f'{LONG} café &amp; €A &am "x y'),
    (page(f"<p>{LONG} in<b>side</b><i> out</i></p>"), f"{LONG} inside out"),
])
def test_pages(html, text):
    assert main_text(html) == text


def test_rules_are_parameters():
    html = page(f"{MENU}<div>The end of the day</div>{MENU}")
    assert main_text(html) == "" and main_text(html, Rules(short=5)) == "The end of the day"
    assert [b.kept for b in classify(page(f"<p>{LONG}</p><nav>x</nav>"))] == [True, False]


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, TEXT string, n_chars string"
    long_page = page("<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>")
    deep = "<div>" * 20_000 + f"<p>{LONG}</p>"
    rows = [(1, None, None, "x", "y"), (None, "u", page(f"<p>{LONG}</p>"), None, None), (2, "u", long_page, "x", "y"),
            (3, "u", deep, "x", "y"), (4, "u", "<p>a", "x", "y"), (4, "u", "<p>a", "x", "y")]
    got = extract_main_text(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    found = sorted(((r.page_id or 0, r.text, r.n_chars) for r in got.collect()))
    long_text = " ".join([LONG] * 20_000)
    assert found == [(0, LONG, len(LONG)), (1, "", 0), (2, long_text, len(long_text)), (3, LONG, len(LONG)),
                     (4, "a", 1), (4, "a", 1)]
    assert extract_main_text(spark.createDataFrame([], schema)).collect() == []
