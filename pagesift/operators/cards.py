"""List cards: one page to an array of card records, and on to one row per card.

The fields are read inside the page row, so nothing is shuffled and the node array never gets
copied once per card.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.functions import text as tx
from pagesift.functions import tree


def card_parts(nodes: str) -> str:
    """The node slices of all cards of a page, in document order."""
    cards = tree.where(nodes, tree.element("article"))
    return tree.each(cards, lambda a: f"slice({nodes}, {a}.ord, {a}.last - {a}.ord + 1)")


def id_text(card: str) -> str:
    return tree.first(card, tree.string_with("NPSN")) + ".text"


def card_name(card: str) -> str:
    return tree.text_of_first(card, tree.element("h3"))


def card_status(card: str, divs: str | None = None) -> str:
    """The highlighted element decides if there is one, even an empty one.

    ``divs`` may hold the ``div`` elements of the card when a caller looks for more than one of them.
    """
    highlighted = tree.first(divs or card, tree.element("div", words=["text-orange-600"]))
    bold = tree.first(divs or card, tree.element("div", words=["font-semibold"]))
    return tree.text_of(card, f"coalesce({highlighted}, {bold})")


def card_address(card: str, divs: str | None = None) -> str:
    return tree.text_of(card, tree.first(divs or card, tree.element("div", words=["line-clamp", "text-xs"])))


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def card_record(card: str) -> str:
    return tree.let(
        tree.where(card, tree.element("div")),
        lambda divs: _struct(
            npsn=tx.id_from_text(id_text(card)),
            nama_sekolah=tx.none_if_empty(card_name(card)),
            alamat_sekolah=tx.none_if_empty(card_address(card, divs)),
            status_sekolah=tx.none_if_empty(card_status(card, divs)),
        ),
    )


def loose_card_record(base_url: str):
    """Card fields by the wider selectors; the profile URL is built from the identifier."""

    def record(card: str) -> str:
        status = tree.text_of_first(card, tree.element("div", words=["font-semibold"]))
        street = tree.text_of_first(card, tree.element("div", words=["line-clamp"]))
        return tree.let(
            tx.id_by_removal(id_text(card)),
            lambda npsn: _struct(
                npsn=npsn,
                url=tx.built_profile_url(npsn, base_url),
                nama_sekolah=tx.none_if_empty(card_name(card)),
                status_sekolah=tx.none_if_empty(status),
                alamat_jalan=tx.none_if_empty(street),
            ),
        )

    return record


def page_cards(nodes: str, record=card_record) -> Column:
    """All cards of a page with their place in it; cards without an identifier are left out."""
    numbered = f"transform({card_parts(nodes)}, (part, i) -> named_struct('pos', i, 'card', {record('part')}))"
    return F.expr(f"filter({numbered}, c -> c.card.npsn IS NOT NULL)")


def with_cards(pages: DataFrame, record=card_record) -> DataFrame:
    """Page rows with ``cards`` in place of ``nodes``."""
    return pages.withColumn("cards", page_cards("nodes", record)).drop("nodes")


def card_rows(pages: DataFrame, *lineage: str) -> DataFrame:
    """One row per card of pages that carry ``cards``; ``lineage`` names page columns to keep.

    The outer form keeps Spark from putting a filter on ``size(cards)`` below the explosion, which
    would extract all cards of every page a second and third time.
    """
    exploded = pages.select(*lineage, F.inline_outer("cards"))
    return exploded.where(F.col("pos").isNotNull()).select(*lineage, "pos", "card.*")


def opened_cards(cards: DataFrame, opened: DataFrame, on: list[str]) -> DataFrame:
    """Give each card the profile URL that was seen after opening it.

    ``opened`` has the keys of ``on``, ``observed_url`` and ``list_url``. Cards that led
    nowhere new get no URL and are left out.
    """
    seen = opened.select(
        *on, F.expr(tx.observed_profile_url("observed_url", "list_url")).alias("url")
    ).where(F.col("url").isNotNull())
    return (
        cards.join(seen, on, "inner")
        .withColumnRenamed("alamat_sekolah", "alamat_jalan")
        .select(*on, "npsn", "url", "nama_sekolah", "status_sekolah", "alamat_jalan")
    )


def published_cards(cards: DataFrame) -> DataFrame:
    """The four list columns in order, gaps marked."""
    return cards.select(*fv.CARD_COLUMNS).na.fill(fv.MISSING)
