"""Profile pages: one wide projection per page, no shuffle.

The work is staged in three projections so that each search over the node array runs once:
candidate nodes and sections first, then the label/value pairs of the blocks, then the fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.config import SiteConfig
from pagesift.functions import text as tx
from pagesift.functions import tree

_BOLD = tree.element("div", words=["font-semibold"])


def staged(pages: DataFrame) -> DataFrame:
    """Add the candidate nodes and section scopes that several fields share."""
    shared = {
        "_strings": tree.where("nodes", tree.is_string),
        "_bold": tree.where("nodes", _BOLD),
        "_statistics": tree.section("nodes", fv.SECTION_STATISTICS),
        "_utilities": tree.section("nodes", fv.SECTION_UTILITIES),
        "_learning": tree.section("nodes", fv.SECTION_LEARNING),
        "_address": tree.section("nodes", fv.SECTION_ADDRESS),
    }
    return pages.selectExpr("*", *[f"{value} AS {name}" for name, value in shared.items()])


# title, address line, documents -------------------------------------------------------------------


def title(nodes: str) -> str:
    return tree.text_of_first(nodes, tree.element("h1"))


def address_line(nodes: str) -> str:
    return tree.text_of_first(nodes, tree.element("p", words=["text-slate-600"]))


def menu_document_url(nodes: str) -> str:
    """Address behind the licence entry of the opened menu."""
    entry = tree.first(
        nodes,
        tree.both(
            tree.element("span"),
            lambda n: f"array_contains(split({n}.cls, {tx.quoted(r'\s+')}), 'p-menu-item-label')",
            tree.with_sole_string(nodes, "SK Operasional"),
        ),
    )
    return tx.none_if_empty(tree.enclosing(nodes, entry, tree.element("a")) + ".href")


def licence_url(nodes: str, profile_url: str, document_base: str) -> str:
    return f"coalesce({tx.document_url(profile_url, document_base)}, {menu_document_url(nodes)})"


# labels and identifier ------------------------------------------------------------------------------


def labelled(label: str, scope: str | None = None, bounded: bool = False) -> str:
    """Label lookup on a staged page."""
    return tree.label_value("nodes", label, scope, bounded, strings="_strings", candidates="_bold")


def profile_id(nodes: str, label_value: str, registry_host: str) -> str:
    """Identifier shown on the profile, if it has the P prefix; a registry link rules out the label."""

    def shown(a: str) -> str:
        value = f"CASE WHEN {a} IS NOT NULL THEN {tree.text_of(nodes, a)} ELSE {label_value} END"
        return tree.let(value, lambda v: f"CASE WHEN {tx.has_p_prefix(v)} THEN {v} END")

    return tree.let(tree.first(nodes, tree.link(registry_host, "npsn")), shown)


# contacts ---------------------------------------------------------------------------------------------


def beside_icon(nodes: str, icon: str) -> str:
    """Scope of the element that holds the icon."""
    return tree.parent_of(nodes, tree.first(nodes, tree.element("i", words=[icon])))


def phone(nodes: str) -> str:
    def read(scope: str) -> str:
        part = tree.under(nodes, scope)
        plain = tree.first(part, tree.element("span", "div", words=["font-semibold"]))
        otherwise = tx.known(tree.text_of(nodes, plain), fv.PHONE_PLACEHOLDERS)
        return tree.let(
            tree.first(part, tree.link("tel:")),
            lambda a: f"CASE WHEN {a} IS NOT NULL THEN {tree.text_of(nodes, a)} ELSE {otherwise} END",
        )

    return tree.let(beside_icon(nodes, "pi-phone"), read)


def website(nodes: str) -> str:
    def read(scope: str) -> str:
        part = tree.under(nodes, scope)
        shown = tx.known(tree.text_of(nodes, tree.first(part, _BOLD)), fv.WEBSITE_PLACEHOLDERS)
        return f"coalesce({tree.first(part, tree.link('http'))}.href, {shown})"

    return tree.let(beside_icon(nodes, "pi-globe"), read)


def email_by_icon(nodes: str) -> str:
    """Mail link nearest to the icon, looked for up to three levels above it."""
    mail = tree.link("mailto:")

    def nearest(one: str, two: str) -> str:
        three = tree.parent_of(nodes, two)
        tiers = [tree.first_under(nodes, scope, mail) for scope in (one, two, three)]
        return tree.text_of(nodes, f"coalesce({', '.join(tiers)})")

    return tree.let(
        beside_icon(nodes, "pi-envelope"),
        lambda one: tree.let(tree.parent_of(nodes, one), lambda two: nearest(one, two)),
    )


def email_anywhere(nodes: str) -> str:
    """First mail link of the page that shows an address other than the support desk's."""
    shown = tree.each(tree.where(nodes, tree.link("mailto:")), lambda a: tree.text_of(nodes, a))
    return f"get(filter({shown}, t -> contains(t, '@') AND NOT contains(lower(t), 'support')), 0)"


def email(nodes: str) -> str:
    return f"coalesce({tx.none_if(email_by_icon(nodes), fv.MISSING)}, {email_anywhere(nodes)})"


# blocks of label/value pairs ----------------------------------------------------------------------------


def keyword_field(label: str, keywords) -> str:
    """Name of the first field whose words fit the label."""
    cases = []
    for name, words, excluded in keywords:
        fits = "(" + " OR ".join(f"contains({label}, {tx.quoted(w)})" for w in words) + ")"
        for word in excluded:
            fits += f" AND NOT contains({label}, {tx.quoted(word)})"
        cases.append(f"WHEN {fits} THEN {tx.quoted(name)}")
    return f"CASE {' '.join(cases)} END"


def _pair(label: str, value: str, keywords) -> str:
    field = tree.let(f"lower({label})", lambda low: keyword_field(low, keywords))
    return f"named_struct('field', {field}, 'value', {value})"


def statistic_pairs(nodes: str, scope: str, label_word: str, keywords) -> str:
    """Big numbers and captions of a block, matched by position up to the shorter list."""

    def pairs(part: str) -> str:
        values = tree.each(
            tree.where(part, tree.element("div", words=["text-2xl"])), lambda e: tree.text_of(nodes, e)
        )
        labels = tree.each(
            tree.where(part, tree.element("div", words=[label_word])), lambda e: tree.text_of(nodes, e)
        )
        pair = f"CASE WHEN l IS NOT NULL AND v IS NOT NULL THEN {_pair('l', 'v', keywords)} END"
        return f"filter(zip_with({labels}, {values}, (l, v) -> {pair}), p -> p IS NOT NULL)"

    return tree.let(tree.under(nodes, scope), pairs)


def learning_pairs(nodes: str, scope: str) -> str:
    """Caption and value of every list item that has both."""

    def pair(item: str) -> str:
        part = tree.under(nodes, item)
        label = tree.text_of(nodes, tree.first(part, tree.element("div", words=["text-slate-600"])))
        value = tree.text_of(nodes, tree.first(part, _BOLD))
        return tree.let(
            f"named_struct('l', {label}, 'v', {value})",
            lambda p: f"CASE WHEN {p}.l IS NOT NULL AND {p}.v IS NOT NULL "
            f"THEN {_pair(f'{p}.l', f'{p}.v', fv.LEARNING_KEYWORDS)} END",
        )

    items = tree.let(
        tree.under(nodes, scope), lambda part: tree.each(tree.where(part, tree.element("li")), pair)
    )
    return f"filter({items}, p -> p IS NOT NULL)"


def last_value(pairs: str, name: str) -> str:
    return tree.last(pairs, lambda p: f"{p}.field = {tx.quoted(name)}") + ".value"


# coordinates ----------------------------------------------------------------------------------------------


def frame_source(nodes: str, scope: str) -> str:
    return tree.first_under(nodes, scope, tree.element("iframe")) + ".src"


def frame_coordinate(source: str, group: int) -> str:
    return tx.captured(source, fv.MAP_PATTERN, group)


def frame_map_link(source: str) -> str:
    lat, lon = frame_coordinate(source, 1), frame_coordinate(source, 2)
    return f"concat({tx.quoted(fv.MAP_LINK)}, {lat}, ',', {lon})"


def coordinate_text(nodes: str, scope: str, label: str) -> str:
    """Text shown for Lintang or Bujur, searched from the parent of the caption onwards."""
    caption = tree.both(tree.element("div"), tree.with_sole_string(nodes, label))
    found = tree.first_under(nodes, scope, caption)
    return tree.text_of(nodes, tree.next_after(nodes, f"{found}.parent", tree.element("div", words=["font-medium"])))


def coordinate(nodes: str, scope: str, source: str, label: str, group: int) -> str:
    """The shown text counts before the map frame."""
    return f"coalesce({coordinate_text(nodes, scope, label)}, {frame_coordinate(source, group)})"


# the projection ---------------------------------------------------------------------------------------------


def with_blocks(pages: DataFrame) -> DataFrame:
    """Staged pages with the pairs of their blocks and the address of the map frame."""
    statistics = statistic_pairs("nodes", "_statistics", "text-slate-600", fv.STATISTIC_KEYWORDS)
    return staged(pages).selectExpr(
        "*",
        f"{statistics} AS _stat_pairs",
        f"{learning_pairs('nodes', '_learning')} AS _learn_pairs",
        f"{frame_source('nodes', '_address')} AS _frame",
    )


def field_expressions(site: SiteConfig, bounded: bool = False) -> dict[str, str]:
    """Every field of a profile as an expression over a page with blocks."""
    fields = {
        "npsn": profile_id("nodes", labelled("NPSN"), site.registry_host),
        "nama_sekolah": title("nodes"),
        "alamat_sekolah": address_line("nodes"),
        "alamat_jalan": "CAST(NULL AS STRING)",
        "url_sk_operasional": licence_url("nodes", "url", site.document_base),
        "telepon": phone("nodes"),
        "website": website("nodes"),
        "email": email("nodes"),
        "lintang": coordinate("nodes", "_address", "_frame", "Lintang", 1),
        "bujur": coordinate("nodes", "_address", "_frame", "Bujur", 2),
        "link_google_map": frame_map_link("_frame"),
    }
    fields |= {name: labelled(label) for name, label in fv.PROFILE_LABELS.items()}
    fields |= {name: labelled(label, "_utilities", bounded) for name, label in fv.UTILITY_LABELS.items()}
    fields |= {name: last_value("_stat_pairs", name) for name, _, _ in fv.STATISTIC_KEYWORDS}
    fields |= {name: last_value("_learn_pairs", name) for name, _, _ in fv.LEARNING_KEYWORDS}
    return fields


def profile_details(
    pages: DataFrame, site: SiteConfig, *lineage: str, bounded: bool = False, rejected: bool = False
) -> DataFrame:
    """Everything a profile page says, one row per page that could be read.

    ``lineage`` names page columns to keep. ``bounded`` keeps the labels of the utilities block
    from reading past their section. ``rejected`` keeps pages that could not be read, with nothing
    but their URL; name ``parse_error`` in the lineage then.
    """
    read = (pages if rejected else pages.where(F.col("parse_error").isNull())).select(*lineage, "url", "nodes")
    fields = field_expressions(site, bounded)
    return with_blocks(read).selectExpr(
        *lineage, *[f"{fields.get(c, c)} AS {c}" for c in fv.PROFILE_COLUMNS]
    )
