"""Selectors over a node array, as SQL expression text (see ``text.py``).

``nodes`` is the array of a whole page or any contiguous part of it (a card). An element or a
scope is a struct with ``ord`` and ``last``; a selector that finds nothing yields NULL and every
function here passes NULL on. A predicate takes the name of a node and returns a condition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.functions.text import known, quoted, strip

Predicate = Callable[[str], str]

_numbers = count()


def _name(prefix: str) -> str:
    return f"{prefix}{next(_numbers)}"


def let(value: str, use: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and hand it to ``use``."""
    v = _name("v")
    return f"get(transform(array({value}), {v} -> {use(v)}), 0)"


def where(nodes: str, test: Predicate) -> str:
    n = _name("n")
    return f"filter({nodes}, {n} -> {test(n)})"


def each(nodes: str, use: Callable[[str], str]) -> str:
    n = _name("n")
    return f"transform({nodes}, {n} -> {use(n)})"


# predicates ---------------------------------------------------------------------------------


def element(*tags: str, words: Iterable[str] = ()) -> Predicate:
    """Element with one of the tags whose class attribute contains every word."""
    choice = ", ".join(quoted(t) for t in tags)
    words = list(words)

    def test(n: str) -> str:
        return " AND ".join([f"{n}.tag IN ({choice})"] + [f"contains({n}.cls, {quoted(w)})" for w in words])

    return test


def link(*parts: str) -> Predicate:
    """Anchor with an address that contains every part."""

    def test(n: str) -> str:
        asked = [f"contains({n}.href, {quoted(p)})" for p in parts] or [f"{n}.href IS NOT NULL"]
        return " AND ".join([f"{n}.tag = 'a'"] + asked)

    return test


def is_string(n: str) -> str:
    return f"startswith({n}.tag, '#')"


def is_text(n: str) -> str:
    return f"{n}.tag IN ({', '.join(quoted(k) for k in fv.TEXT_KINDS)})"


def string_with(label: str) -> Predicate:
    """Any string, comments and scripts included, that contains the label."""
    return lambda n: f"{is_string(n)} AND contains({n}.text, {quoted(label)})"


def with_sole_string(nodes: str, label: str) -> Predicate:
    """Element whose only string contains the label."""
    return lambda n: f"contains(get({nodes}, {n}.sole - 1).text, {quoted(label)})"


def both(*tests: Predicate) -> Predicate:
    return lambda n: " AND ".join(f"({t(n)})" for t in tests)


# selection ------------------------------------------------------------------------------------


def first(nodes: str, test: Predicate) -> str:
    return f"get({where(nodes, test)}, 0)"


def last(nodes: str, test: Predicate) -> str:
    return f"try_element_at({where(nodes, test)}, -1)"


def whole(nodes: str) -> str:
    """The page itself as a scope."""
    return f"named_struct('ord', 0, 'last', size({nodes}), 'parent', CAST(NULL AS INT))"


def under(nodes: str, scope: str) -> str:
    """The nodes inside an element: a slice, because a subtree is contiguous."""
    return f"slice({nodes}, {scope}.ord - get({nodes}, 0).ord + 2, {scope}.last - {scope}.ord)"


def first_under(nodes: str, scope: str, test: Predicate) -> str:
    return let(scope, lambda s: first(under(nodes, s), test))


def parent_of(nodes: str, node: str) -> str:
    """Enclosing element of a node of a whole page; the page itself at the top."""

    def up(p: str) -> str:
        inner = let(f"get({nodes}, {p} - 1)", lambda n: f"named_struct('ord', {n}.ord, 'last', {n}.last, 'parent', {n}.parent)")
        return f"CASE WHEN {p} > 0 THEN {inner} WHEN {p} = 0 THEN {whole(nodes)} END"

    return let(f"{node}.parent", up)


def enclosing(nodes: str, node: str, test: Predicate) -> str:
    """Nearest ancestor that passes the test."""
    return let(node, lambda s: last(nodes, both(test, lambda n: f"{n}.ord < {s}.ord AND {n}.last >= {s}.ord")))


def next_after(nodes: str, number: str, test: Predicate) -> str:
    """First node later in the document than ``number``, wherever it is nested."""
    return let(number, lambda o: first(nodes, lambda n: f"{n}.ord > {o} AND {test(n)}"))


def inside(scope: str) -> Predicate:
    return lambda n: f"{n}.ord > {scope}.ord AND {n}.ord <= {scope}.last"


# text -------------------------------------------------------------------------------------------


def text_of(nodes: str, node: str) -> str:
    """Text of an element: each string stripped, empty ones dropped, joined without a gap."""

    def joined(e: str) -> str:
        strings = each(where(under(nodes, e), is_text), lambda n: strip(f"{n}.text"))
        return f"array_join({strings}, '')"

    return let(node, joined)


def raw_text(nodes: str) -> str:
    """All text of the nodes as it stands."""
    return f"array_join({each(where(nodes, is_text), lambda n: f'{n}.text')}, '')"


def text_of_first(nodes: str, test: Predicate) -> str:
    return text_of(nodes, first(nodes, test))


# labels and sections ------------------------------------------------------------------------------


def section(nodes: str, title: str) -> str:
    """Parent of the first second-level heading whose only string contains the title."""
    return parent_of(nodes, first(nodes, both(element("h2"), with_sole_string(nodes, title))))


def after_label(
    label: str,
    strings: str,
    candidates: str,
    test: Predicate,
    scope: str | None = None,
    bounded: bool = False,
) -> str:
    """First candidate that passes the test after the parent of the first string with the label.

    The label is searched inside ``scope``. The value is searched to the end of the page, so a
    label without a value takes the next field's; ``bounded=True`` keeps it inside the scope.
    """
    labelled = string_with(label)
    if scope is None:
        return next_after(candidates, f"{first(strings, labelled)}.parent", test)
    return let(
        scope,
        lambda s: next_after(
            candidates,
            f"{first(strings, both(inside(s), labelled))}.parent",
            both(inside(s), test) if bounded else test,
        ),
    )


def label_value(
    nodes: str,
    label: str,
    scope: str | None = None,
    bounded: bool = False,
    strings: str | None = None,
    candidates: str | None = None,
) -> str:
    """Value shown for a label, NULL when it is missing or a placeholder.

    ``strings`` and ``candidates`` may hold the string nodes and the value elements of the page
    when a caller looks up many labels; by default both are searched for in ``nodes``.
    """
    shown = after_label(
        label, strings or nodes, candidates or nodes, element("div", words=["font-semibold"]), scope, bounded
    )
    return known(text_of(nodes, shown))


def value_by_label(nodes: str, label: str, scope: str | None = None, bounded: bool = False) -> Column:
    """Column with the value shown for ``label``; ``nodes`` and ``scope`` name columns."""
    return F.expr(label_value(nodes, label, scope, bounded))
