"""HTML to node arrays: the one stage that runs in Python.

A page becomes an array of its elements and strings in document order. ``ord`` counts from 1,
so a node sits at position ``ord`` of the array; ``last`` is the end of its subtree; ``parent``
is 0 for the page itself. Descendants of ``e`` are therefore the slice ``e.ord + 1 .. e.last``,
and "next in document order" is a larger ``ord``. ``sole`` is the ``ord`` of the one string an
element holds through single-child elements, 0 if there is none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pagesift import fixed_values as fv
from pagesift.session import ship

NODE_TYPE = T.StructType(
    [
        T.StructField("ord", T.IntegerType()),
        T.StructField("last", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        T.StructField("sole", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("cls", T.StringType()),
        T.StructField("href", T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
_ARROW_NODE = pa.struct(
    [(f.name, pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string()) for f in NODE_TYPE]
)
_NODES_PER_BATCH = 200_000

# The markup that browsers write when they save a page: lower-case tags, quoted attributes, closed
# references. It means the same to every tokenizer, so patterns may split it: a page into strings and
# what stands in angle brackets (a bracket that is not closed is told apart), that into tags.
_PIECES = re.compile(r"([^<]*)(?:<([^<>]*)>|(<)|\Z)")
_START_TAG = re.compile(
    r"""([a-z][a-z0-9]*)((?:[ \t\n\r\f]+[a-z][a-z0-9_:.-]*(?:="[^"<>]*")?)*)[ \t\n\r\f]*(/?)"""
)
_END_TAG = re.compile(r"/([a-z][a-z0-9]*)")
_REFERENCE = re.compile(r"&(?:([a-zA-Z][a-zA-Z0-9]*)|\#([0-9]{1,7}));")
_DOCTYPE = "!DOCTYPE html"
_BLANKS = " \n\t\f\r"
_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9_:.-]*)(?:="([^"]*)")?""")
_RAW = {tag: re.compile(rf"</\s*{tag}|<!--", re.IGNORECASE) for tag in ("script", "style")}
_RAW_START = re.compile(r"<(script|style)\b[^<>]*>")
# what these hold is split differently by different versions of the tokenizer
_UNSETTLED = frozenset(["title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext", "listing"])
_UNUSUAL = fv.VOID_ELEMENTS | fv.SPECIAL_STRING_ELEMENTS | fv.KEEP_BLANKS_ELEMENTS
_NO_ATTRIBUTES = (None, None, None)
# what stands in angle brackets: nothing plain, tags, tags that need more than a place in the tree, the rest
_WILD, _START, _END, _UNUSUAL_START, _UNUSUAL_END, _MARK = range(6)


@lru_cache(maxsize=4096)
def _kept_attributes(text: str) -> tuple[str | None, str | None, str | None]:
    """Class, href and src out of the attributes of one tag; tags repeat, so most are known already."""
    found = {name: unescape(value) for name, value in _ATTRIBUTE.findall(text)}
    return found.get("class"), found.get("href"), found.get("src")


def _referenced(name: str) -> str:
    return html5.get(name + ";", html5.get(name, "&" + name))


def _character(code: int) -> str:
    """Character of a numeric reference; the range below 256 is read as the old Windows code page."""
    try:
        char = bytes([code]).decode("windows-1252") if code < 256 else chr(code)
    except UnicodeDecodeError:
        char = chr(code)
    except (ValueError, OverflowError):
        char = "\N{REPLACEMENT CHARACTER}"
    if "\ud800" <= char <= "\udfff":  # half a pair cannot be stored as text
        char = "\N{REPLACEMENT CHARACTER}"
    return char


def _resolved(match: re.Match) -> str:
    return _referenced(match[1]) if match[1] else _character(int(match[2]))


class _NodeWriter(HTMLParser):
    """Collects the nodes of one page after another.

    Plain markup is split by patterns; a page with anything else goes through the standard
    tokenizer from its start. Both feed the same tree. Tags repeat, so a node holds the number of its
    tag and attributes among all that were met.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.number: list[int] = []
        self.parent: list[int] = []
        self.kind: list[int] = []
        self.text: list[str | None] = []
        self.last: list[int] = []
        self.sole: list[int] = []
        self.kinds: dict[tuple, int] = {}  # tag, class, href, src
        self.is_string: list[bool] = []  # by kind
        self.known: dict[str, tuple[int, str, int]] = {}  # what stands in angle brackets

    def write_page(self, html: str) -> None:
        base = len(self.number)
        try:
            self._start_page()
            if not self._split_plain(html):
                self._drop_from(base)
                self._start_page()
                self.feed(html)
                self.close()
            self._flush()
            self._close_down_to(1)
        except Exception:
            self._drop_from(base)
            raise

    def columns(self) -> pa.StructArray:
        kind = pa.array(self.kind, pa.int32())
        named = zip(*self.kinds) if self.kinds else [()] * 4
        values = {name: pa.array(of, pa.string()).take(kind) for name, of in zip(("tag", "cls", "href", "src"), named)}
        values |= dict(ord=self.number, last=self.last, parent=self.parent, sole=self.sole, text=self.text)
        fields = [values[f.name] if f.name in ("tag", "cls", "href", "src") else pa.array(values[f.name], f.type) for f in _ARROW_NODE]
        return pa.StructArray.from_arrays(fields, fields=list(_ARROW_NODE))

    def _drop_from(self, base: int) -> None:
        for column in (self.number, self.parent, self.kind, self.text, self.last, self.sole):
            del column[base:]

    def _start_page(self) -> None:
        self.reset()
        self.base = len(self.number)
        self.open = [["", 0, 0, 0]]  # tag, ord, number of children, last child
        self.special: list[str] = []
        self.kept_blanks = 0
        self.pending: list[str] = []
        self.closed_void: dict[str, int] = {}

    def _kind_of(self, tag: str, attributes: tuple = _NO_ATTRIBUTES) -> int:
        key = (tag, *attributes)
        kind = self.kinds.get(key)
        if kind is None:
            kind = self.kinds[key] = len(self.kinds)
            self.is_string.append(tag[0] == "#")
        return kind

    def _plain_tag(self, inner: str) -> tuple[int, str, int]:
        """What the text in angle brackets is, the name of the tag and, of a start tag, the kind of node."""
        tag = _START_TAG.fullmatch(inner)
        if tag:
            usual = not tag[3] and tag[1] not in _UNUSUAL and tag[1] not in _RAW and tag[1] not in _UNSETTLED
            return (_START if usual else _UNUSUAL_START), tag[1], self._kind_of(tag[1], _kept_attributes(tag[2]))
        tag = _END_TAG.fullmatch(inner)
        if tag:
            return (_UNUSUAL_END if tag[1] in _UNUSUAL else _END), tag[1], -1
        return (_MARK if inner == _DOCTYPE or inner.startswith("!--") else _WILD), "", -1

    def _split_plain(self, html: str) -> bool:
        """Split a page of plain markup; False as soon as something else turns up."""
        known, pending, open_, base = self.known, self.pending, self.open, self.base
        numbers, parents, kinds, texts, last, sole = self.number, self.parent, self.kind, self.text, self.last, self.sole
        is_string, string = self.is_string, self._kind_of("#text")
        usual = True  # strings here are text of the page, and blank ones are cut to one character
        place = 0
        while True:
            for token in _PIECES.finditer(html, place):
                text, inner, _ = token.groups()
                if text and "&" in text:
                    text, n = _REFERENCE.subn(_resolved, plain := text)
                    if n != plain.count("&"):
                        return False
                if inner is None:
                    found = (_MARK, "", -1)
                else:
                    found = known.get(inner)
                    if found is None:
                        found = known[inner] = self._plain_tag(inner)
                what, tag, kind = found
                if what == _START or what == _END:
                    if text and usual and not pending:
                        if text[0] in _BLANKS and not text.strip(_BLANKS):
                            text = "\n" if "\n" in text else " "
                        number = len(numbers) - base + 1
                        top = open_[-1]
                        top[2] += 1
                        top[3] = number
                        numbers.append(number)
                        parents.append(top[1])
                        kinds.append(string)
                        texts.append(text)
                        last.append(number)
                        sole.append(0)
                    elif text or pending:
                        if text:
                            pending.append(text)
                        self._flush()
                    top = open_[-1]
                    if what == _START:
                        number = len(numbers) - base + 1
                        top[2] += 1
                        top[3] = number
                        numbers.append(number)
                        parents.append(top[1])
                        kinds.append(kind)
                        texts.append(None)
                        last.append(number)
                        sole.append(0)
                        open_.append([tag, number, 0, 0])
                    elif top[0] == tag:
                        open_.pop()
                        at = base + top[1] - 1
                        last[at] = len(numbers) - base
                        if top[2] == 1:
                            child = top[3]
                            sole[at] = child if is_string[kinds[base + child - 1]] else sole[base + child - 1]
                    else:
                        self.handle_endtag(tag)
                        usual = not (self.special or self.kept_blanks)
                    continue
                if text:
                    pending.append(text)
                if what == _WILD:
                    return False
                place = token.end()
                if what == _UNUSUAL_END:
                    self.handle_endtag(tag)
                elif what == _UNUSUAL_START:
                    self._start(tag, kind)
                    if inner[-1] == "/":
                        self.handle_endtag(tag)
                    elif tag in _RAW:
                        stop = html.find(f"</{tag}>", place)
                        if stop < 0 or _RAW[tag].search(html, place, stop):
                            return False
                        if stop > place:
                            pending.append(html[place:stop])
                        self.handle_endtag(tag)
                        place = stop + len(tag) + 3
                        usual = not (self.special or self.kept_blanks)
                        break
                    elif tag in _UNSETTLED:
                        stop = html.find("<", place)
                        if not html.startswith(f"</{tag}>", stop) or "&" in html[place:stop]:
                            return False
                elif inner == _DOCTYPE:
                    self._marked("#doctype", inner[1:])
                else:
                    place = token.end(1)
                    if place == len(html):
                        return True
                    place += 4
                    stop = html.find("-->", place)
                    if not html.startswith("<!--", place - 4) or stop < 0 or html.startswith((">", "->"), place):
                        return False
                    if html.find("--", place, stop + 2) != stop:
                        return False
                    self._marked("#comment", html[place:stop])
                    place = stop + 3
                    break
                usual = not (self.special or self.kept_blanks)

    def _add(self, kind: int, text: str | None) -> int:
        number = len(self.number) - self.base + 1
        top = self.open[-1]
        top[2] += 1
        top[3] = number
        self.number.append(number)
        self.parent.append(top[1])
        self.kind.append(kind)
        self.text.append(text)
        self.last.append(number)
        self.sole.append(0)
        return number

    def _flush(self, kind: str | None = None) -> None:
        """Close the string being collected; adjacent pieces make one string."""
        pending = self.pending
        if not pending:
            return
        text = pending[0] if len(pending) == 1 else "".join(pending)
        pending.clear()
        if not self.kept_blanks and not text.strip(_BLANKS):
            text = "\n" if "\n" in text else " "
        if kind is None:
            kind = "#" + self.special[-1] if self.special else "#text"
        self._add(self._kind_of(kind), text)

    def _close_down_to(self, depth: int) -> None:
        base, open_, sole = self.base, self.open, self.sole
        end = len(self.number) - base
        while len(open_) > depth:
            tag, number, children, child = open_.pop()
            self.last[base + number - 1] = end
            if children == 1:
                sole[base + number - 1] = child if self.is_string[self.kind[base + child - 1]] else sole[base + child - 1]
            if tag in _UNUSUAL:
                if tag in fv.SPECIAL_STRING_ELEMENTS:
                    self.special.pop()
                else:
                    self.kept_blanks -= 1

    def _start(self, tag: str, kind: int) -> None:
        if self.pending:
            self._flush()
        number = self._add(kind, None)
        if tag not in _UNUSUAL:
            self.open.append([tag, number, 0, 0])
        elif tag in fv.VOID_ELEMENTS:
            self.closed_void[tag] = self.closed_void.get(tag, 0) + 1
        else:
            self.open.append([tag, number, 0, 0])
            if tag in fv.SPECIAL_STRING_ELEMENTS:
                self.special.append(tag)
            else:
                self.kept_blanks += 1

    def _marked(self, kind: str, text: str) -> None:
        self._flush()
        self.pending.append(text)
        self._flush(kind)

    # callbacks of the tokenizer

    def handle_starttag(self, tag, attrs):
        kept = dict(attrs)
        attributes = tuple(kept[k] or "" if k in kept else None for k in ("class", "href", "src"))
        self._start(tag, self._kind_of(tag, attributes))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self.closed_void.get(tag):  # already closed when it was opened
            self.closed_void[tag] -= 1
            return
        if self.pending:
            self._flush()
        open_ = self.open
        depth = len(open_) - 1
        while depth and open_[depth][0] != tag:
            depth -= 1
        if depth:
            self._close_down_to(depth)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(_referenced(name))

    def handle_charref(self, name):
        hexadecimal = name[0] in "xX"
        self.pending.append(_character(int(name[1:], 16) if hexadecimal else int(name)))

    def handle_comment(self, data):
        self._marked("#comment", data)

    def handle_decl(self, decl):
        self._marked("#doctype", decl)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._marked("#cdata", data[len("CDATA[") :])
        else:
            self._marked("#declaration", data)

    def handle_pi(self, data):
        self._marked("#instruction", data)


# what a piece of a page is to the arrays: an element with content, its end, one without, a string that is not text, an
# element with such a string, one with nothing but text, no tag at all; what is other is left to the writer
_OTHER, _OPENS, _ENDS, _ALONE, _MARKED, _HOLDS_RAW, _HOLDS_TEXT, _NOTHING = range(8)


class _Pieces(dict):
    """Number of what stands in angle brackets; what it is comes from the writer, once for each."""

    def __init__(self, writer: _NodeWriter) -> None:
        self.writer = writer
        self.role: list[int] = []
        self.tag: list[int] = []
        self.kind: list[int] = []
        self.text: list[str | None] = []
        self.tags: dict[str, int] = {}

    def __missing__(self, inner: str) -> int:
        what, tag, kind = self.writer._plain_tag(inner)
        role, text = _OTHER, None
        if what == _START:
            role = _OPENS
        elif what == _END:
            role = _ENDS
        elif what == _UNUSUAL_START and inner[-1] == "/":
            role = _ALONE if tag in fv.VOID_ELEMENTS or tag not in _UNUSUAL else _OTHER
        elif what == _UNUSUAL_START:
            role = _ALONE if tag in fv.VOID_ELEMENTS else _HOLDS_RAW if tag in _RAW else _HOLDS_TEXT if tag not in _UNUSUAL else _OTHER
        elif what == _UNUSUAL_END:
            role = _ENDS if tag in _RAW else _OTHER
        elif inner == _DOCTYPE:
            role, kind, text = _MARKED, self.writer._kind_of("#doctype"), inner[1:]
        elif what == _MARK and inner.endswith("--") and len(inner) > 4 and "--" not in inner[3:-1]:
            role, kind, text = _MARKED, self.writer._kind_of("#comment"), inner[3:-2]
            if not text.strip(_BLANKS):
                text = "\n" if "\n" in text else " "
        self.role.append(role)
        self.tag.append(self.tags.setdefault(tag, len(self.tags)))
        self.kind.append(kind)
        self.text.append(text)
        number = self[inner] = len(self.role) - 1
        return number


def _without_brackets(html: str) -> str | None:
    """A page with "\\0" for the brackets in its scripts and styles; None if a tokenizer may see more in them."""
    parts, done, start = [], 0, _RAW_START.search(html)
    while start:
        stop = html.find(f"</{start[1]}>", start.end())
        if stop < 0:
            return None
        raw = html[start.end() : stop]
        if "<" in raw:
            if _RAW[start[1]].search(raw):
                return None
            parts += [html[done : start.end()], raw.replace("<", "\0")]
            done = stop
        start = _RAW_START.search(html, stop)
    return "".join([*parts, html[done:]]) if parts else html


def _by_level(levels: np.ndarray) -> np.ndarray:
    """Places in the order of their levels, those of one level as they come; numbers of 16 bits are sorted by digits."""
    return np.argsort(levels.astype(np.int16) if levels.max(initial=0) < 1 << 15 else levels, kind="stable")


class _PageArrays:
    """Nodes of many pages at once, worked out as arrays where every element of a plain page is closed in its turn.

    A page is cut at its brackets; which element holds a node, and where that ends, follows from the depths of the pieces.
    Any other page goes through the writer; both give the same nodes.
    """

    def __init__(self, cut: bool = True) -> None:
        self.writer = _NodeWriter()
        self.pieces = _Pieces(self.writer)
        self.cut = cut  # whether pages are cut at all; pages of one source are alike, so the caller may know
        self.pages: list[str | None] = []
        self.taken: list[int] = []  # pages that were cut, their pieces and the text after each
        self.sizes: list[int] = []
        self.codes: list[int] = []
        self.texts: list[str] = []
        self.size = 0  # pieces, of which each gives two nodes at most

    def add_page(self, html: str | None) -> None:
        pieces = 0
        if html is not None:
            try:
                pieces = self._cut(html) if self.cut else 0
            except Exception:  # the writer says what is wrong with it
                pieces = 0
            self.size += pieces or html.count("<") + 1
        if pieces:
            self.taken.append(len(self.pages))
            self.sizes.append(pieces)
        self.pages.append(html)

    def _cut(self, html: str) -> int:
        """Cut a page into pieces and count them; none if the page cannot be plain."""
        if "\0" in html:
            return 0
        hidden = _without_brackets(html)
        if hidden is None:
            return 0
        before, *rest = hidden.split("<")
        if not rest:
            return 0
        inners, closed, after = zip(*[piece.partition(">") for piece in rest])
        if "" in closed:
            return 0
        pieces, role = self.pieces, self.pieces.role
        codes = [-1, *[pieces[inner] for inner in inners]]
        texts = [before, *after]
        if hidden is not html:
            texts = [text.replace("\0", "<") for text in texts]
        for k, text in enumerate(texts):
            if text:
                if "&" in text:
                    what = role[codes[k]] if k else _OTHER
                    if what == _HOLDS_RAW:
                        continue
                    fixed, n = _REFERENCE.subn(_resolved, text)
                    if n != text.count("&") or what == _HOLDS_TEXT:
                        return 0
                    texts[k] = text = fixed
                if text[0] in _BLANKS and not text.strip(_BLANKS):
                    texts[k] = "\n" if "\n" in text else " "
        self.codes += codes
        self.texts += texts
        return len(codes)

    def nodes(self) -> tuple[pa.ListArray, list[str | None]]:
        """The nodes of every page added, and what kept a page from being read."""
        plain, counts, good = self._plain()
        self.cut = self.cut and 2 * len(good) >= len(self.taken)
        n, writer = len(self.pages), self.writer
        begins, ends, errors = np.zeros(n, np.int64), np.zeros(n, np.int64), [None] * n
        ends[good] = np.cumsum(counts)
        begins[good] = ends[good] - counts
        others = np.setdiff1d(np.arange(n), good)
        for k in others.tolist():
            begun = len(writer.number)
            if self.pages[k] is None:
                errors[k] = "no html"
            else:
                try:
                    writer.write_page(self.pages[k])
                except Exception as problem:  # a page that cannot be read must not stop the others
                    errors[k] = f"{type(problem).__name__}: {problem}"
            begins[k], ends[k] = len(plain) + begun, len(plain) + len(writer.number)
        found = plain
        if writer.number:
            sizes = ends - begins
            place = np.arange(sizes.sum()) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)
            found = pa.concat_arrays([plain, writer.columns()]).take(pa.array(place))
        offsets = np.concatenate([[0], np.cumsum(ends - begins)])
        missing = pa.array([e is not None for e in errors], pa.bool_())
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found, mask=missing), errors

    def _plain(self) -> tuple[pa.StructArray, np.ndarray, np.ndarray]:
        """The nodes of the plain pages, how many each has, and which pages they are."""
        sizes = np.array(self.sizes, np.int64)
        if not len(sizes):
            return pa.array([], _ARROW_NODE), sizes, sizes
        code = np.array(self.codes, np.int64)
        role = np.array([*self.pieces.role, _NOTHING], np.int8)[code]  # the last one is that of -1, before the first tag
        tag = np.array([*self.pieces.tag, -1], np.int64)[code]
        page = np.repeat(np.arange(len(sizes)), sizes)
        opens, ends = np.isin(role, (_OPENS, _HOLDS_RAW, _HOLDS_TEXT)), role == _ENDS
        good = np.ones(len(sizes), bool)
        good[page[role == _OTHER]] = False
        holds = np.flatnonzero((role == _HOLDS_RAW) | (role == _HOLDS_TEXT))
        after = np.minimum(holds + 1, len(code) - 1)
        good[page[holds[(role[after] != _ENDS) | (tag[after] != tag[holds])]]] = False
        step = opens.astype(np.int64) - ends
        firsts = np.cumsum(sizes) - sizes
        depth = np.cumsum(step)
        depth -= np.repeat((depth - step)[firsts], sizes)
        good &= (np.minimum.reduceat(depth, firsts) >= 0) & (np.add.reduceat(step, firsts) == 0)
        # in the pages left, the elements of one depth open and end in turns
        events = np.flatnonzero((opens | ends) & good[page])
        events = events[_by_level((depth + ends)[events])]
        good[page[events[0::2][tag[events[0::2]] != tag[events[1::2]]]]] = False
        events = events[good[page[events]]]
        opened, ended = events[0::2], events[1::2]

        kept = good[page]
        is_tag = kept & (role != _ENDS) & (role != _NOTHING)
        is_text = kept & np.fromiter(map(bool, self.texts), bool, len(code))
        upto = np.cumsum(is_tag.astype(np.int64) + is_text)
        n = int(upto[-1])
        tag_at, text_at = (upto - is_text - 1)[is_tag], (upto - 1)[is_text]
        kind, level, holder = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
        kind[tag_at] = np.array(self.pieces.kind, np.int64)[code[is_tag]]
        kind[text_at] = self.writer._kind_of("#text")
        for raw in _RAW:
            if raw in self.pieces.tags:
                inside = (role == _HOLDS_RAW) & (tag == self.pieces.tags[raw])
                kind[(upto - 1)[is_text & inside]] = self.writer._kind_of("#" + raw)
        level[tag_at], level[text_at] = (depth - opens)[is_tag], depth[is_text]
        holder[tag_at] = opens[is_tag]
        last = np.arange(n)
        last[(upto - is_text - 1)[opened]] = (upto - is_text)[ended] - 1

        # among the nodes of one level and the elements that hold them, in order, the holder of a node is the last before it
        item = np.repeat(np.arange(n), 1 + holder)
        is_holder = np.zeros(len(item), bool)
        is_holder[1:] = item[1:] == item[:-1]
        at = level[item] + is_holder
        order = _by_level(at)
        item, is_holder, at = item[order], is_holder[order], at[order]
        latest = item[np.maximum(np.maximum.accumulate(np.where(is_holder, np.arange(len(item)), -1)), 0)]
        parent = np.empty(n, np.int64)
        parent[item[~is_holder]] = np.where(at > 0, latest, -1)[~is_holder]

        single = np.bincount(parent[parent >= 0], minlength=n) == 1
        is_string = np.array(self.writer.is_string)[kind]
        sole = np.where(single, np.arange(1, n + 1), -1)
        through = np.flatnonzero(single)
        while len(through := through[~is_string[sole[through]]]):
            child = sole[through]
            sole[through] = np.where(single[child], child + 1, -1)
            through = through[single[child]]

        counts = np.add.reduceat(is_tag.astype(np.int64) + is_text, firsts)[good]
        base = np.repeat(np.cumsum(counts) - counts, counts)
        text = np.empty(n, np.int64)
        text[tag_at], text[text_at] = len(code) + code[is_tag], np.flatnonzero(is_text)
        strings = pa.concat_arrays([pa.array(self.texts, pa.string()), pa.array(self.pieces.text, pa.string())])
        numbers = dict(ord=np.arange(n), last=last, parent=np.where(parent < 0, base - 1, parent), sole=np.where(sole < 0, base - 1, sole))
        values = {name: pa.array((of - base + 1).astype(np.int32)) for name, of in numbers.items()}
        values["text"] = strings.take(pa.array(text))
        for name, of in zip(("tag", "cls", "href", "src"), zip(*self.writer.kinds)):
            values[name] = pa.array(of, pa.string()).take(pa.array(kind))
        nodes = pa.StructArray.from_arrays([values[f.name] for f in _ARROW_NODE], fields=list(_ARROW_NODE))
        return nodes, counts, np.array(self.taken)[good]


def _node_batches(batches: Iterator[pa.RecordBatch], html_column: str) -> Iterator[pa.RecordBatch]:
    arrays = _PageArrays()
    for batch in batches:
        pages = batch.column(html_column)
        kept = [n for n in batch.schema.names if n != html_column]
        start = 0
        for i in range(len(pages)):
            arrays.add_page(pages[i].as_py())
            if 2 * arrays.size >= _NODES_PER_BATCH or i == len(pages) - 1:
                nodes, errors = arrays.nodes()
                done = batch.slice(start, i + 1 - start)
                columns = [done.column(n) for n in kept] + [nodes, pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=kept + ["nodes", "parse_error"])
                arrays, start = _PageArrays(arrays.cut), i + 1


def with_nodes(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """Replace the HTML column by ``nodes`` and ``parse_error``; one page in, one row out.

    Select only the columns that are needed later before calling: all others travel through
    the Python worker with the HTML.
    """
    kept = [f for f in pages.schema if f.name != html_column]
    schema = T.StructType(
        kept
        + [
            T.StructField("nodes", T.ArrayType(NODE_TYPE)),
            T.StructField("parse_error", T.StringType()),
        ]
    )
    ship(pages.sparkSession)
    return pages.mapInArrow(lambda batches: _node_batches(batches, html_column), schema)
