"""Pages whose markup leaves out what may be left out, and text in formulas and drawings."""

import pytest

from pagesift.llm import article

LONG = "A paragraph that holds enough words to be told from a menu, as any reader of this page would say at once."
TREE = article.trained()


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>x</title><article><p>{LONG}</p><p>{LONG}</p></article>",
        f"<html><head><meta charset=utf-8><link rel=a href=b><script>var a;</script><style>p {{}}</style><p>{LONG}<p>{LONG}",
        f"<head><title>x</title><base href=a><noscript>no</noscript>\n <div><p>{LONG}</p><p>{LONG}</p></div>",
        f"<head><title>x</title></head><body><p>{LONG}</p><head><p>{LONG}</p></body>",
        f"<title>x</title><p>{LONG}</p><p>{LONG}</p>",
    ],
)
def test_head_without_end(page):
    assert article.main_text(page, TREE) == f"{LONG}\n\n{LONG}"


def test_text_right_behind_the_head():
    assert article.main_text(f"<head><title>x</title>{LONG} <b>And</b> more.", TREE) == f"{LONG} And more."
    assert article.main_text(f"<head><title>x</title>{LONG}", TREE) == LONG


def test_head_alone_is_empty():
    assert article.main_text("<html><head><title>x</title><meta name=a> <link href=b>\n", TREE) == ""


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("<math><mi>x</mi></math>", "x"),
        ("<math><mrow><mi>x</mi><mo>+</mo><mn>1</mn></mrow><annotation encoding='t'>x+1</annotation></math>", "x+1"),
        ("<svg><title>t</title><style>a {}</style><path d='M0'/><text x='1'>Figure <tspan>one</tspan></text></svg>", "Figure one"),
        ("<svg><path d='M0'/></svg>", ""),
        ("<map name=m><area href=a>north</map>", "north"),
    ],
)
def test_formulas_and_drawings(inner, want):
    page = f"<article><p>{LONG} the value {inner} holds</p><p>{LONG}</p></article>"
    assert article.main_text(page, TREE) == " ".join(f"{LONG} the value {want} holds".split()) + f"\n\n{LONG}"
