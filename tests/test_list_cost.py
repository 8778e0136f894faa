"""What a list page costs: a tag is read once and a card's elements are searched once."""

from __future__ import annotations

import pytest

from pagesift.operators import cards as cd
from pagesift.plans import run as runs
from pagesift.sources import html_nodes

CARD = '<article class="p-card"><!-- card -->\n<div class="head"><span>NPSN : 1</span></div><br><h3>A <b>&amp; B</b></h3></article>\n'


def test_a_tag_that_comes_again_is_not_read_again(monkeypatch):
    read = []
    plain_tag = html_nodes._NodeWriter._plain_tag
    monkeypatch.setattr(html_nodes._NodeWriter, "_plain_tag", lambda self, inner: read.append(inner) or plain_tag(self, inner))
    writer = html_nodes._NodeWriter()
    for _ in range(3):
        writer.write_page("<html><body>" + CARD * 20 + "</body></html>")
    assert sorted(read) == sorted(set(read)) and 'article class="p-card"' in read


@pytest.mark.parametrize(
    "html",
    [
        CARD * 3,
        "a &lt; b &#65;&#130;<p> \n </p>x</q>y</br><br/></br>z",
        "<pre> \n </pre><p>  </p><script>if (a < b) c > d</script><style></style>",
        "<div><p>a</div>b<!-- <i> --><i/>c",
        "<template> <b>x</b></div></template> <b> </b>",
    ],
)
def test_split_by_patterns_as_by_the_tokenizer(monkeypatch, html):
    writer = html_nodes._NodeWriter()
    writer._start_page()
    assert writer._split_plain(html)
    plain, tokenized = html_nodes._NodeWriter(), html_nodes._NodeWriter()
    plain.write_page(html)
    monkeypatch.setattr(html_nodes._NodeWriter, "_split_plain", lambda self, html: False)
    tokenized.write_page(html)
    assert plain.columns().to_pylist() == tokenized.columns().to_pylist()


@pytest.mark.parametrize("html", ["a < b", "<p", "<!-- a -- b -->", "<!-- a", "&lt", "<P>x</P>", "<script><!-- x</script>"])
def test_other_markup_goes_to_the_tokenizer(html):
    writer = html_nodes._NodeWriter()
    writer._start_page()
    assert not writer._split_plain(html)


def test_the_whole_card_is_searched_once_for_its_divs():
    assert cd.card_record("card").count("filter(card, ") == 3  # divs, headings, strings


def test_pages_that_were_not_loaded_are_not_parsed(spark):
    rows = [(0, CARD, True), (1, CARD, False), (2, CARD, None), (3, "<p>", True), (4, None, True), (5, None, False)]
    pages = spark.createDataFrame(rows, "page_num INT, html STRING, success BOOLEAN").selectExpr("*", "TIMESTAMP '2024-05-06' AS fetched_at")
    found = {r.page_num: r for r in runs.page_results(pages).collect()}
    assert {n: (r.ok, r.n_rows, r.error) for n, r in found.items()} == {
        0: (True, 1, None), 1: (False, 0, "not loaded"), 2: (False, 0, "not loaded"),
        3: (False, 0, "no rows"), 4: (False, 0, "no html"), 5: (False, 0, "not loaded"),
    }
    assert [n for n, r in found.items() if r.cards] == [0]
