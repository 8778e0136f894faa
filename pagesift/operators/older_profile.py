"""The older profile layout: rounded cards told apart by the words they contain, page-wide blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.functions import text as tx
from pagesift.functions import tree
from pagesift.operators.profile import last_value, statistic_pairs, title

# --- fixed values: field, words of which one must be in the card, part of the card to read ----------
CARD_KEYWORDS = [
    ("alamat_sekolah", ["Alamat"], "caption"),
    ("url_sk_operasional", ["SK Operasional"], "address"),
    ("akreditasi", ["Akreditasi"], "bold"),
    ("kepala_sekolah", ["Kepala Sekolah"], "bold"),
    ("telepon", ["Telepon", "No. Telp"], "phone"),
    ("website", ["Website"], "web"),
    ("bentuk_pendidikan", ["Bentuk Pendidikan"], "bold"),
    ("operator", ["Operator"], "bold"),
    ("email", ["Email"], "mail"),
    ("yayasan", ["Yayasan"], "bold"),
]


def keyword_cards(nodes: str) -> str:
    """Every rounded card with its whole text and the parts a field may be read from."""

    def parts(part: str) -> str:
        def text(test: tree.Predicate) -> str:
            return tree.text_of(nodes, tree.first(part, test))

        address = tree.first(part, tree.link()) + ".href"
        return (
            f"named_struct('text', {tree.raw_text(part)},"
            f" 'caption', {text(tree.element('div', words=['text-slate-600']))},"
            f" 'bold', {text(tree.element('div', words=['font-semibold']))},"
            f" 'phone', {text(tree.link('tel:'))},"
            f" 'mail', {text(tree.link('mailto:'))},"
            f" 'address', {address},"
            f" 'web', get(filter(array({address}), h -> contains(h, 'http')), 0))"
        )

    cards = tree.where(nodes, tree.element("div", words=["rounded"]))
    return tree.each(cards, lambda card: tree.let(tree.under(nodes, card), parts))


def card_field(cards: str, words: list[str], part: str) -> str:
    """Value of the last card that mentions one of the words and has the part."""

    def mentions(card: str) -> str:
        hits = " OR ".join(f"contains({card}.text, {tx.quoted(w)})" for w in words)
        return f"({hits}) AND {card}.{part} IS NOT NULL"

    return f"{tree.last(cards, mentions)}.{part}"


def card_status(cards: str) -> str:
    """Cards that mention the status always set it; any card sets it while it is still unset."""
    unset = tx.quoted(fv.MISSING)
    bold = f"filter({cards}, c -> c.bold IS NOT NULL)"
    take = f"CASE WHEN contains(c.text, 'Status') OR now = {unset} THEN c.bold ELSE now END"
    return tx.none_if(f"aggregate({bold}, {unset}, (now, c) -> {take})", fv.MISSING)


def text_after(nodes: str, page_text: str, label: str, test: tree.Predicate) -> str:
    """Text of the first fitting element after the label, if the page text has the label at all."""
    found = tree.text_of(nodes, tree.after_label(label, nodes, nodes, test))
    return f"CASE WHEN contains({page_text}, {tx.quoted(label)}) THEN {found} END"


def map_link(nodes: str) -> str:
    return tree.first(nodes, tree.link("maps.google.com")) + ".href"


def with_blocks(pages: DataFrame) -> DataFrame:
    """Pages with their keyword cards, statistic pairs and whole text."""
    statistics = tree.let(
        tree.whole("nodes"),
        lambda page: statistic_pairs("nodes", page, "text-slate-500", fv.OLDER_STATISTIC_KEYWORDS),
    )
    return pages.selectExpr(
        "*",
        f"{keyword_cards('nodes')} AS _cards",
        f"{statistics} AS _stat_pairs",
        f"{tree.raw_text('nodes')} AS _text",
    )


def field_expressions() -> dict[str, str]:
    """Every field of an older profile as an expression over a page with blocks."""
    bold = tree.element("div", words=["font-semibold"])
    fields = {
        "nama_sekolah": title("nodes"),
        "status_sekolah": card_status("_cards"),
        "kurikulum": text_after("nodes", "_text", "Kurikulum", bold),
        "lintang": text_after("nodes", "_text", "Lintang", tree.element("div")),
        "bujur": text_after("nodes", "_text", "Bujur", tree.element("div")),
        "link_google_map": map_link("nodes"),
    }
    fields |= {name: card_field("_cards", words, part) for name, words, part in CARD_KEYWORDS}
    fields |= {name: last_value("_stat_pairs", name) for name, _, _ in fv.OLDER_STATISTIC_KEYWORDS}
    return fields


def older_details(pages: DataFrame, *lineage: str, rejected: bool = False) -> DataFrame:
    """Everything an older profile page says, one row per page that could be read.

    Fields that this layout does not show are NULL. ``rejected`` keeps pages that could not be read.
    """
    read = (pages if rejected else pages.where(F.col("parse_error").isNull())).select(*lineage, "url", "nodes")
    fields = field_expressions() | {"url": "url"}
    return with_blocks(read).selectExpr(
        *lineage, *[f"{fields.get(c, 'CAST(NULL AS STRING)')} AS {c}" for c in fv.PROFILE_COLUMNS]
    )
