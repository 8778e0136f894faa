"""Main text of web pages: flat blocks, judged by their own and their neighbours' words and links.

A page is cut at block-level tags into flat text blocks. Of each block, and of the ones before and after it, the number of
words and the share of words inside links are known, and what encloses it: an article, or something that names itself
a menu, a footer, an advert, a form, comments and so on. Words decide where names conflict: an article counts if it is not
inside such a part and the articles hold most of the page's words without links; the class of a wrapper counts for nothing if
most words and all articles are inside, nearly all where there is no article. A decision tree, trained on the small labelled table below,
decides whether a block belongs to the article.

Defined results: null and empty pages give an empty text; markup that is cut off counts as far as it goes, and a head that is not
closed ends where a browser ends it, at the first text or at a tag that may not be in it; the text of formulas and drawings
belongs to its block; rows that repeat a page are read each; very long pages are read whole, by one task. Extra columns are
not read, whatever their names. Character references are decoded, white space inside a block becomes one blank.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.common import ship, strings

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "aside", "article", "outside", "heading")

# A labelled table: the features of blocks as above, and whether the block belongs to the article. "outside" means that
# the page has an article which the block is not in.
LABELLED = (
    # inside an article: paragraphs of any length, headings, quotes, list items
    (45, 0.0, 12, 0.0, 60, 0.0, 0, 1, 0, 0, 1), (9, 0.0, 40, 0.0, 38, 0.0, 0, 1, 0, 0, 1), (2, 0.0, 30, 0.0, 25, 0.0, 0, 1, 0, 0, 1),
    (12, 0.0, 7, 0.0, 55, 0.0, 0, 1, 0, 1, 1), (6, 0.0, 0, 0.0, 3, 0.0, 0, 1, 0, 1, 1), (30, 0.4, 22, 0.0, 18, 0.1, 0, 1, 0, 0, 1),
    (5, 0.0, 80, 0.1, 0, 0.0, 0, 1, 0, 0, 1), (8, 1.0, 50, 0.0, 41, 0.0, 0, 1, 0, 0, 1), (120, 0.05, 1, 1.0, 1, 1.0, 0, 1, 0, 0, 1),
    (3, 0.0, 6, 1.0, 4, 1.0, 0, 1, 0, 1, 1), (1, 0.0, 1, 0.0, 1, 0.0, 0, 1, 0, 0, 1), (17, 0.0, 12, 0.0, 5, 0.0, 0, 1, 0, 0, 1),
    # inside something that calls itself a menu, an advert, a notice, a form, comments, also within an article
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0, 0), (14, 0.0, 1, 1.0, 11, 0.0, 1, 0, 1, 0, 0), (40, 0.0, 35, 0.0, 50, 0.0, 1, 1, 0, 0, 0),
    (22, 0.1, 60, 0.0, 18, 0.0, 1, 1, 0, 0, 0), (9, 0.0, 2, 0.0, 3, 0.0, 1, 0, 0, 0, 0), (70, 0.0, 30, 0.0, 0, 0.0, 1, 0, 1, 0, 0),
    (4, 0.0, 12, 0.0, 50, 0.0, 1, 0, 0, 1, 0), (5, 0.5, 0, 0.0, 7, 0.3, 1, 0, 1, 0, 0), (33, 0.0, 28, 0.0, 31, 0.0, 1, 0, 0, 0, 0),
    (3, 1.0, 44, 0.0, 52, 0.0, 1, 1, 0, 0, 0), (12, 0.0, 15, 0.0, 12, 0.0, 1, 1, 0, 1, 0), (58, 0.0, 9, 0.0, 90, 0.0, 1, 0, 0, 0, 0),
    # beside an article that the page has
    (25, 0.0, 2, 1.0, 12, 0.0, 0, 0, 1, 0, 0), (6, 0.0, 1, 1.0, 40, 0.0, 0, 0, 1, 1, 0), (48, 0.1, 50, 0.0, 20, 0.0, 0, 0, 1, 0, 0),
    (3, 1.0, 3, 1.0, 3, 1.0, 0, 0, 1, 0, 0), (80, 0.0, 66, 0.0, 4, 0.5, 0, 0, 1, 0, 0), (11, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 0, 0),
    # pages without an article: running text, headings before it, short lines within it
    (44, 0.0, 51, 0.0, 39, 0.0, 0, 0, 0, 0, 1), (28, 0.1, 3, 1.0, 46, 0.0, 0, 0, 0, 0, 1), (65, 0.2, 40, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (19, 0.0, 6, 0.0, 33, 0.0, 0, 0, 0, 0, 1), (7, 0.0, 41, 0.0, 36, 0.0, 0, 0, 0, 0, 1), (4, 0.0, 30, 0.0, 29, 0.1, 0, 0, 0, 0, 1),
    (8, 0.0, 2, 1.0, 52, 0.0, 0, 0, 0, 1, 1), (5, 0.0, 34, 0.0, 61, 0.0, 0, 0, 0, 1, 1), (16, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1),
    (22, 0.0, 3, 0.0, 22, 0.0, 0, 0, 0, 0, 1), (22, 0.0, 22, 0.0, 1, 1.0, 0, 0, 0, 0, 1), (18, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0, 1),
    (31, 0.1, 5, 0.5, 4, 1.0, 0, 0, 0, 0, 1), (27, 0.0, 9, 0.0, 8, 0.0, 0, 0, 0, 0, 1), (60, 0.0, 12, 0.0, 10, 0.2, 0, 0, 0, 0, 1),
    (40, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0, 1), (75, 0.2, 3, 0.0, 2, 0.0, 0, 0, 0, 0, 1), (24, 0.0, 55, 0.0, 6, 0.0, 0, 0, 0, 0, 1),
    (140, 0.0, 4, 1.0, 200, 0.0, 0, 0, 0, 0, 1), (52, 0.1, 70, 0.1, 64, 0.0, 0, 0, 0, 0, 1), (33, 0.0, 5, 0.0, 44, 0.0, 0, 0, 0, 0, 1),
    (3, 0.0, 2, 1.0, 22, 0.0, 0, 0, 0, 1, 1), (4, 0.0, 26, 0.0, 30, 0.0, 0, 0, 0, 1, 1), (6, 0.0, 5, 0.0, 70, 0.0, 0, 0, 0, 1, 1),
    (35, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 1), (22, 0.0, 18, 0.0, 4, 0.0, 0, 0, 0, 0, 1), (90, 0.3, 1, 1.0, 70, 0.1, 0, 0, 0, 0, 1),
    # pages without an article: link lists, menus without a name, lone short lines
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0), (18, 0.9, 4, 1.0, 12, 0.8, 0, 0, 0, 0, 0), (3, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0, 0),
    (5, 0.0, 3, 1.0, 4, 0.0, 0, 0, 0, 0, 0), (30, 0.8, 25, 0.0, 20, 0.9, 0, 0, 0, 0, 0), (4, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0, 0),
    (6, 1.0, 45, 0.0, 3, 1.0, 0, 0, 0, 0, 0), (2, 0.0, 3, 1.0, 1, 1.0, 0, 0, 0, 1, 0), (7, 0.0, 50, 0.0, 0, 0.0, 0, 0, 0, 0, 0),
    (3, 0.5, 2, 0.5, 3, 1.0, 0, 0, 0, 0, 0), (1, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0, 0), (24, 0.7, 2, 1.0, 2, 1.0, 0, 0, 0, 0, 0),
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|title|textarea|select|option|button|svg|iframe|object|canvas|audio|video|annotation-xml|annotation)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z!?][^>]*(?:>|\Z)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr map area"
    " math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd"
    " mtext mtr munder munderover none semantics".split()
)
_HEAD_TAGS = frozenset("html head base basefont bgsound link meta noframes script style noscript template title".split())  # any other tag ends the head
_DRAWN = re.compile(r"<text\b[^>]*(?<!/)>(.*?)(?:</text\s*>|\Z)", re.I | re.S)
_TAG = re.compile(r"<[^>]*>")
_SCOPES = frozenset("html body div section article main nav header footer aside form ul ol dl table figure fieldset details dialog menu center blockquote".split())
_ASIDE_TAGS = frozenset("nav footer aside form dialog menu fieldset".split())
_ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement adsense banner banners promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert sidebar side widget widgets"
    " menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments reply replies disqus respond share sharing social related recommended newsletter"
    " subscribe subscription signup login search popup modal overlay toolbar pagination pager copyright legal complementary contentinfo".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSED_BY_BLOCKS = _HEADINGS | {"p"}
_CLOSED_BY_NEXT = {"li": "ul ol menu", "tr": "table", "td": "tr table", "th": "tr table", "dt": "dl", "dd": "dl"}
_LAYOUT = frozenset("has no with without".split())  # has-sidebar tells of a layout, not of what is inside
_WRAPPER, _MOST = 0.8, 0.5  # shares of a page's words without links


def _named_aside(rest: str) -> bool:
    for found in _ATTRIBUTE.finditer(rest):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", found[1] or found[2] or found[3] or "")
        tokens = re.split(r"([^a-z]+)", value.lower())
        for k in range(0, len(tokens), 2):
            layout = k and tokens[k - 2] in _LAYOUT and not tokens[k - 1].isspace()
            if tokens[k] in _ASIDE_NAMES and not layout:
                return True
    return False


def _enclosures(words: np.ndarray, around: list[list[tuple]], scopes: list[tuple]) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of each block whether it is in an aside and in an article that counts, and whether the page has such an article.

    ``scopes`` and ``around`` are of (number, aside by tag, aside by name, article): what encloses a scope, with itself at
    the end, and a block.
    """
    by_tag = np.array([any(t[1] for t in a) for a in around], bool)
    text = words * ~by_tag
    articles = [a for a in scopes if a[-1][3] and not any(t[1] for t in a)]
    named = set()
    for a in scopes:
        number = a[-1][0]
        if a[-1][2]:
            held = text @ np.array([any(t[0] == number for t in b) for b in around], float)
            share = _MOST if articles else _WRAPPER
            wraps = held >= share * text.sum() > 0 and not any(t[3] for t in a) and all(any(t[0] == number for t in b) for b in articles)
            if not wraps:
                named.add(number)
    aside = by_tag | np.array([any(t[0] in named for t in a) for a in around], bool)
    counted = {a[-1][0] for a in articles if not any(t[0] in named for t in a)}
    inside = np.array([any(t[0] in counted for t in a) for a in around], bool)
    text = words * ~aside
    if not (has := bool(inside.any() and text @ inside >= _MOST * text.sum())):
        inside[:] = False
    return aside, inside, has


def blocks_of(html: str) -> tuple[list[str], np.ndarray]:
    """Texts of the blocks and their features, one row each."""
    texts: list[str] = []
    marks: list[tuple[float, ...]] = []
    open_tags: list[tuple[str, tuple[int, bool, bool, bool]]] = []  # name; number, aside by tag, aside by name, article
    around: list[list[tuple]] = []
    scopes: list[list[tuple]] = []
    parts: list[str] = []
    in_link = linked = 0
    heading, head = False, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                words = text.count(" ") + 1
                texts.append(text)
                marks.append((words, min(linked / words, 1.0), heading))
                around.append([t for _, t in open_tags if any(t[1:])])
            parts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if in_link:
            linked += len(piece.split())

    at = 0
    for found in _TOKEN.finditer(html):
        piece = html[at : found.start()]
        at = found.end()
        name, raw = (found["name"] or "").lower(), (found["raw"] or "").lower()
        end = bool(found["end"])
        if piece.strip() or (raw or name and not end) and (raw or name) not in _HEAD_TAGS:
            head = 0
        if piece and not head:
            add(piece)
        if not name:
            if raw == "svg":
                for drawn in _DRAWN.findall(found[0]):
                    add(f" {_TAG.sub('', drawn)} ")
            elif raw and not raw.startswith("annotation"):
                close()
            continue
        if name == "a":
            in_link = 0 if end else 1
        elif name == "br":
            parts.append(" ")
        if name in _INLINE:
            continue
        close()
        if name == "head":
            head = 0 if end else 1
        elif name == "body":
            head = 0
        if name in _HEADINGS:
            heading = not end
        if not end and open_tags and open_tags[-1][0] in _CLOSED_BY_BLOCKS:
            open_tags.pop()
        if not end and name in _CLOSED_BY_NEXT:
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] in _CLOSED_BY_NEXT[name].split():
                    break
                if open_tags[k][0] == name or {open_tags[k][0], name} in ({"td", "th"}, {"dt", "dd"}):
                    del open_tags[k:]
                    break
        if name in _SCOPES or name in _CLOSED_BY_BLOCKS or name in _CLOSED_BY_NEXT:
            if not end:
                inside = any(t[3] for _, t in open_tags)
                article = name in ("article", "main")
                by_tag = name in _ASIDE_TAGS or name == "header" and not inside
                by_name = name not in ("html", "body", "article", "main") and _named_aside(found["rest"])
                if not found["rest"].endswith("/"):
                    open_tags.append((name, (len(scopes), by_tag, by_name, article)))
                    if by_tag or by_name or article:
                        scopes.append([t for _, t in open_tags if any(t[1:])])
            else:
                places = [k for k, t in enumerate(open_tags) if t[0] == name]
                if places:
                    del open_tags[places[-1] :]
            if name in _SCOPES:
                in_link = 0
    if at < len(html) and (html[at:].strip() or not head):
        add(html[at:])
    close()
    m = np.array(marks, np.float64).reshape(-1, 3)
    none = np.zeros((1, 2))
    before, after = np.concatenate([none, m[:-1, :2]]), np.concatenate([m[1:, :2], none])
    if not len(m):
        before = after = np.zeros((0, 2))
    aside, article, has_article = _enclosures(m[:, 0] * (1 - m[:, 1]), around, scopes)
    return texts, np.column_stack([m[:, :2], before, after, aside, article, ~article & has_article, m[:, 2]])


def grow_tree(table: np.ndarray, labels: np.ndarray, least: int = 1) -> tuple:
    """A decision tree: (feature, cut, low branch, high branch), or the share of article blocks in a leaf.

    Every split takes the feature and cut with the lowest Gini impurity, the first one on a tie.
    """
    share = float(labels.mean())
    best = (2 * share * (1 - share) * len(labels) - 1e-9, None, None)
    for feature in range(table.shape[1]):
        values = np.unique(table[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = table[:, feature] <= cut
            if min(low.sum(), (~low).sum()) < least:
                continue
            impurity = sum(2 * p * (1 - p) * n for p, n in ((labels[s].mean(), s.sum()) for s in (low, ~low)))
            if impurity < best[0]:
                best = (impurity, feature, cut)
    if best[1] is None or share in (0.0, 1.0):
        return (share,)
    low = table[:, best[1]] <= best[2]
    return (best[1], float(best[2]), grow_tree(table[low], labels[low], least), grow_tree(table[~low], labels[~low], least))


def judge(tree: tuple, row: np.ndarray) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def trained(labelled=LABELLED) -> tuple:
    table = np.array(labelled, np.float64)
    return grow_tree(table[:, :-1], table[:, -1])


def main_text(html: str, tree: tuple) -> str:
    texts, rows = blocks_of(html)
    return "\n\n".join(t for t, row in zip(texts, rows) if judge(tree, row) >= 0.5)


def with_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), tree: tuple | None = None) -> DataFrame:
    """``keep`` columns and the ``text`` of the article of every page; empty if there is none. No row is moved."""
    ship(pages.sparkSession)
    known = tree or trained()
    kept = list(keep)
    schema = T.StructType([pages.schema[c] for c in kept]).add("text", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, known) for h in strings(batch.column("_html"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=schema.names)

    return pages.select(*kept, F.col(html).alias("_html")).mapInArrow(run, schema)
