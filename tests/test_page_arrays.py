"""Nodes worked out for many pages at once against the writer's, page by page."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_html_nodes import nodes_of

from pagesift.sources import html_nodes
from pagesift.sources.html_nodes import _node_batches, _PageArrays

PLAIN = [
    '<div class="a"><p>a<b>c</b></p> \n </div><i>d</i>',
    "<!DOCTYPE html><html><head><title>t</title><script>if (a < b) c > '</p>' & d</script><style> </style></head></html>",
    "a &lt; b &#65;&#32;<p>&#32;</p><!-- c --><!----><br>x<br/><img src=\"q\"><i/>y<h2><span>Z</span></h2>",
    '<a href="/x&amp;y">l</a><script></script><iframe src="a"></iframe><section><h2><b><i>n</i></b></h2></section>z',
    "<p><!-- only --></p><script src=\"x\"></script><title/>",
]
OTHER = [
    "", "text", "<p>a", "a</p>", "<b><i>x</b></i>", "<p", "a < b", "&lt", "&unknown; & x<b></b>", "<P>x</P>", "</br>", "<pre> \n </pre>",
    "<template><b> x</b></template>", "<textarea> </textarea>", "<title>a&amp;b</title>", "<title><b>x</b></title>", '<a title="x>y">l</a>',
    "<script>a</ script>b</script>", "<script>a", "<!-- <script>a<b</script> -->", "<!-- a--->", "<!--->", "<!--a--b-->", "<script/>a<b>c</b>",
    "<style>a<!-- <b> --></style>", "<title>a<script>x<y</script></title>", "<script-x>a<b</script>", "<p>\0</p>", "<?php x ?>", "<![CDATA[x]]>",
]


def at_once(pages):
    arrays = _PageArrays()
    for html in pages:
        arrays.add_page(html)
    nodes, errors = arrays.nodes()
    return nodes.to_pylist(), errors


def expected(html):
    try:
        return nodes_of(html)
    except Exception:
        return None


@pytest.mark.parametrize("pages", [PLAIN, OTHER, [*OTHER, *PLAIN, *OTHER, None], [x for pair in zip(PLAIN, OTHER) for x in pair], [None], []])
def test_many_pages_as_one_by_one(pages):
    nodes, errors = at_once(pages)
    assert nodes == [None if html is None else expected(html) for html in pages]
    assert [e is None for e in errors] == [html is not None and expected(html) is not None for html in pages]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*PLAIN, *OTHER, "<div>", "</div>", "<b>", "</b>", "x", " ", "&amp;"]), max_size=8).map("".join), max_size=8))
def test_any_pages_as_one_by_one(pages):
    assert at_once(pages)[0] == [expected(html) for html in pages]


def test_plain_pages_do_not_go_through_the_writer(monkeypatch):
    def fail(self, html):
        raise AssertionError("written: " + html)

    wanted = [nodes_of(html) for html in PLAIN]
    monkeypatch.setattr(html_nodes._NodeWriter, "write_page", fail)
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(PLAIN))), "html": PLAIN})
    rows = [r for b in _node_batches(iter([batch]), "html") for r in b.to_pylist()]
    assert [r["nodes"] for r in rows] == wanted and {r["parse_error"] for r in rows} == {None}


def test_pages_are_no_longer_cut_where_it_was_in_vain():
    arrays = _PageArrays()
    for html in ["<p><b>x</p>", "<p><b>y</p>", PLAIN[0]]:
        arrays.add_page(html)
    arrays.nodes()
    assert not arrays.cut
    rest = _PageArrays(arrays.cut)
    rest.add_page(PLAIN[0])
    assert rest.taken == [] and rest.nodes()[0].to_pylist() == [nodes_of(PLAIN[0])]
