"""The node array against hand-written trees, and its two tokenizers against each other."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagesift.sources.html_nodes import _node_batches, _NodeWriter, with_nodes


class _OnlyTokenizer(_NodeWriter):
    def _split_plain(self, html):
        return False


def nodes_of(html, writer=_NodeWriter):
    w = writer()
    w.write_page(html)
    return w.columns().to_pylist()


def brief(html):
    return [(n["parent"], n["last"], n["tag"] if n["text"] is None else n["text"]) for n in nodes_of(html)]


def test_tree_numbers():
    assert brief("<div><p>a<b>c</b></p></div><i>d</i>") == [
        (0, 5, "div"), (1, 5, "p"), (2, 3, "a"), (2, 5, "b"), (4, 5, "c"), (0, 7, "i"), (6, 7, "d"),
    ]


def test_open_elements_close_at_the_end_and_stray_ends_are_ignored():
    assert brief("<div><p>a</i></div>b</p><p>c") == [
        (0, 3, "div"), (1, 3, "p"), (2, 3, "a"), (0, 4, "b"), (0, 6, "p"), (5, 6, "c"),
    ]


def test_void_elements_hold_nothing():
    assert brief("<br>a<img/>b</br>c") == [(0, 1, "br"), (0, 2, "a"), (0, 3, "img"), (0, 4, "bc")]


def test_kinds_of_strings():
    kinds = {n["text"]: n["tag"] for n in nodes_of(
        "<!DOCTYPE html><!-- c --><script>var a = '<b>';</script><style>p{}</style>"
        "<template><p>t</p></template><ruby><rt>r</rt></ruby><p>x</p><![CDATA[y]]>"
    ) if n["text"] is not None}
    assert kinds["var a = '<b>';"] == "#script"
    assert kinds["p{}"] == "#style" and kinds["t"] == "#template" and kinds["r"] == "#rt"
    assert kinds["x"] == "#text" and kinds[" c "] == "#comment" and kinds["DOCTYPE html"] == "#doctype"
    assert kinds["y"] == "#cdata"


def test_references():
    texts = [n["text"] for n in nodes_of("<p>a&amp;b&nbsp;c&#65;&#x42;&#150;&unknown;&#55296;&#0;</p>")]
    assert texts == [None, "a&b cAB–&unknown�\x00"]


def test_blank_strings_shrink_outside_pre():
    assert [n["text"] for n in nodes_of("<p>  \n </p><p>   </p><pre>  \n </pre>") if n["text"]] == ["\n", " ", "  \n "]


def test_sole_string():
    found = {n["ord"]: n["sole"] for n in nodes_of("<h2><span>a</span></h2><h2><i></i> a</h2><p><!--c--></p>")}
    assert found == {1: 3, 2: 3, 3: 0, 4: 0, 5: 0, 6: 0, 7: 8, 8: 0}


def test_last_of_repeated_attributes_counts_and_empty_ones_are_kept():
    node = nodes_of('<a class="x" class="y z" href>t</a>')[0]
    assert (node["cls"], node["href"], node["src"]) == ("y z", "", None)


_PIECES = st.sampled_from(
    ["<div>", "</div>", '<p class="a b">', "</p>", "<br>", "<br/>", "</br>", "<b>", "</b>", "<script>", "</script>",
     "if (a < b) {}", "<!-- c -->", "<!---->", "<!-->", "<!--a--b-->", "text", " ", "\n", "&amp;", "&#65;", "&x;", "&",
     "<", ">", '<a href="/x?a&amp;b" href="y">', "</a>", "<A HREF=z>", "<title>", "</title>", "<textarea>", "</textarea>",
     "<iframe src=\"q\">", "</iframe>", "<style>", "</style>", "<pre>", "</pre>", "<!DOCTYPE html>", "<!doctype x>",
     "<img src='s'>", "<img src=\"s\" alt/>", "</ div>", "<1>", "<?pi?>", "<![CDATA[z]]>", "<div class=\"k\">", "<p class=\"a>b\">"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(_PIECES, max_size=14).map("".join))
def test_both_tokenizers_agree(html):
    def run(writer):
        try:
            return nodes_of(html, writer)
        except AssertionError as problem:
            return str(problem)

    assert run(_NodeWriter) == run(_OnlyTokenizer)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="<>/!-&;#\"'= abp\n", max_size=40))
def test_any_text_gives_a_tree(html):
    try:
        nodes = nodes_of(html)
    except AssertionError:
        return
    assert [n["ord"] for n in nodes] == list(range(1, len(nodes) + 1))
    for n in nodes:
        assert n["parent"] < n["ord"] <= n["last"] <= len(nodes)
        if n["parent"]:
            assert n["last"] <= nodes[n["parent"] - 1]["last"]
    assert nodes == nodes_of(html, _OnlyTokenizer)


def test_batches_keep_rows_together(monkeypatch):
    monkeypatch.setattr("pagesift.sources.html_nodes._NODES_PER_BATCH", 5)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4], "html": ["<p>a</p>" * 3, None, "", "<i>b</i>"]})
    rows = [r for b in _node_batches(iter([batch]), "html") for r in b.to_pylist()]
    assert [r["id"] for r in rows] == [1, 2, 3, 4]
    assert [None if r["nodes"] is None else len(r["nodes"]) for r in rows] == [6, None, 0, 2]
    assert [r["parse_error"] for r in rows] == [None, "no html", None, None]


def test_unreadable_page_is_reported_not_raised(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>"), (2, "<![weird"), (3, None)], "id INT, html STRING")
    rows = {r.id: r for r in with_nodes(pages).collect()}
    assert rows[1].parse_error is None and len(rows[1].nodes) == 2
    assert rows[3].parse_error == "no html" and rows[3].nodes is None
    assert set(rows) == {1, 2, 3}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages_split_alike(spark, testdata, sf):
    for row in spark.read.parquet(f"{testdata}/{sf}/pages.parquet").select("html").collect():
        assert nodes_of(row.html) == nodes_of(row.html, _OnlyTokenizer)
