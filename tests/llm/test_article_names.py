"""Names and tags around a block do not lose an article, nor keep an advert in it."""

import pytest

from pagesift.llm import article

TEXT = "This paragraph has quite a few words, and tells something that a reader of the page came to read in the end."
BODY = f"<h2>A heading here</h2><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p>"
WANT = "\n\n".join(["A heading here", TEXT, TEXT, TEXT])


@pytest.mark.parametrize(
    "page",
    [
        f"<aside><article><p>A teaser of something else to read.</p></article></aside><div>{BODY}</div>",
        f'<div>{BODY}</div><div class="related"><article><p>A teaser of something else to read.</p></article></div>',
        f'<div class="page has-sidebar">{BODY}</div>',
        f'<div class="no-sidebar"><article>{BODY}</article></div>',
        f'<div class="site-header-social widget"><article>{BODY}</article></div><div id=comments><p>{TEXT}</p></div>',
        f'<div class="widget">{BODY}</div>',
        f'<article><h2 class="ad">Buy</h2>{BODY}<p class="advert">{TEXT}</p><ul><li class=promo>{TEXT}<ul><li>{TEXT}</ul></ul></article>',
        f'<article>{BODY}</article><div class="comments">{BODY * 9}</div>',
    ],
)
def test_names(page):
    assert article.main_text(f"<body><nav><a href=a>Home</a></nav>{page}</body>", article.trained()) == WANT


def test_block_after_a_named_one_stays():
    page = f"<article><p class=ad>Buy now.<p>{TEXT}<table><tr class=ad><td>Buy<td>more<tr><td>{TEXT}</table></article>"
    assert article.main_text(page, article.trained()) == f"{TEXT}\n\n{TEXT}"
