"""Scalar helpers and selectors on hand-written input."""

import pytest
from pages import evaluate, literal, parsed

from pagesift import value_by_label
from pagesift import fixed_values as fv
from pagesift.functions import text as tx
from pagesift.functions import tree


@pytest.mark.parametrize(
    "text, expected",
    [
        ("NPSN : 20123456", "20123456"),
        ("NPSN:P9", "P9"),
        ("x NPSN  : 20é1 y", "20é1"),
        ("NPSN : 12_3-4", "12_3"),
        ("NPSN 12", None),
        ("NPSN : ", None),
        ("npsn : 1", None),
        ("NPSN : 1 NPSN : 2", "1"),
        ("NPSN\x1c: ½٣", "½٣"),
    ],
)
def test_id_from_text(spark, text, expected):
    assert literal(spark, tx.id_from_text, text) == expected


def test_id_by_removal(spark):
    assert literal(spark, tx.id_by_removal, " NPSN : 20 : 1 NPSN ") == "20  1"
    assert literal(spark, tx.id_by_removal, "NPSN: ") is None


def test_strip_takes_every_unicode_blank(spark):
    assert literal(spark, tx.strip, " \t\n\x0b\x1f\x85 　a b  ") == "a b"
    padded = spark.createDataFrame([(blank + "x" + blank,) for blank in fv.BLANKS], "v STRING").coalesce(1)
    assert {r.x for r in padded.selectExpr(tx.strip("v") + " AS x").collect()} == {"x"}


@pytest.mark.parametrize("sign", ["—", "–", "-", "−", "―", "‐", "‑", "‒", "", " "])
def test_general_placeholders(spark, sign):
    assert literal(spark, tx.known, sign) is None


def test_placeholder_sets_differ(spark):
    assert literal(spark, lambda v: tx.known(v, fv.PHONE_PLACEHOLDERS), "‑") == "‑"
    assert literal(spark, lambda v: tx.known(v, fv.PHONE_PLACEHOLDERS), "―") is None
    assert literal(spark, lambda v: tx.known(v, fv.WEBSITE_PLACEHOLDERS), "BELUM TERISI") is None
    assert literal(spark, lambda v: tx.known(v, fv.WEBSITE_PLACEHOLDERS), "Belum TERISI") == "Belum TERISI"
    assert literal(spark, tx.known, "Belum Terisi") == "Belum Terisi"


def test_document_url(spark):
    def build(v):
        return tx.document_url(v, "https://f/sk/")

    assert literal(spark, build, "https://x/profil-sekolah/0aF-9/more") == "https://f/sk/0aF-9.pdf"
    assert literal(spark, build, "https://x/PROFIL-SEKOLAH/ABC?z") == "https://f/sk/ABC.pdf"
    assert literal(spark, build, "https://x/profil-sekolah/xyz") is None


def test_observed_url(spark):
    frame = spark.createDataFrame(
        [("l", "l"), ("l", "h/profil-sekolah/1"), ("l", "h/login"), ("h/profil-sekolah/1", "h/profil-sekolah/1"), ("l", None)],
        "list STRING, seen STRING",
    )
    found = frame.selectExpr(tx.observed_profile_url("seen", "list") + " AS u").collect()
    assert [r.u for r in found] == [None, "h/profil-sekolah/1", None, None, None]


def test_text_joins_stripped_strings_without_a_gap(spark):
    html = "<div> A <b> B </b>\n<!-- no --><script>no</script><i> </i>C d </div>"
    assert evaluate(spark, html, tree.text_of_first("nodes", tree.element("div"))) == "ABC d"
    assert evaluate(spark, "<p></p>", tree.text_of_first("nodes", tree.element("p"))) == ""
    assert evaluate(spark, "<p></p>", tree.text_of_first("nodes", tree.element("h1"))) is None


def test_raw_text_keeps_blanks(spark):
    assert evaluate(spark, "<p> a <b>b</b>\n</p>c", tree.raw_text("nodes")) == " a b\nc"


def test_enclosing_finds_the_nearest(spark):
    html = '<a href="1"><a href="2"><span>x</span></a></a>'
    span = tree.first("nodes", tree.element("span"))
    assert evaluate(spark, html, tree.enclosing("nodes", span, tree.element("a")) + ".href") == "2"
    assert evaluate(spark, "<span>x</span>", tree.enclosing("nodes", span, tree.element("a")) + ".href") is None


def test_section_needs_a_sole_string(spark):
    def ord_of(html):
        return evaluate(spark, html, tree.section("nodes", "Alamat") + ".ord")

    assert ord_of("<section><h2><span>Alamat</span></h2></section>") == 1
    assert ord_of("<section><h2><i></i> Alamat</h2></section>") is None
    assert ord_of("<section><h2>Alamat</h2></section><section><h2>Alamat 2</h2></section>") == 1
    assert ord_of("<h2>Alamat</h2>") == 0


def _value(spark, html, label="Operator"):
    return parsed(spark, html).select(value_by_label("nodes", label).alias("x")).first().x


def test_label_lookup(spark):
    assert _value(spark, '<p><b>Operator</b></p><div class="x font-semibold"> Ani <b>B</b></div>') == "AniB"
    assert _value(spark, '<div class="font-semibold">before</div><b>Operator</b>') is None
    assert _value(spark, '<b>Operator</b><span class="font-semibold">s</span><div class="font-semibold">d</div>') == "d"
    assert _value(spark, '<b>Operator</b><div class="font-semibold">—</div><div class="font-semibold">n</div>') is None


def test_label_reads_on_into_the_next_field(spark):
    html = '<b>Operator</b><b>Yayasan</b><div class="font-semibold">Y</div>'
    assert _value(spark, html) == "Y"


def test_value_may_stand_inside_the_labels_parent(spark):
    assert _value(spark, '<div>Operator<div class="font-semibold">in</div></div>') == "in"


def test_label_in_a_comment_or_script_counts(spark):
    html = '<!-- Operator --><div class="font-semibold">first</div><b>Operator</b><div class="font-semibold">second</div>'
    assert _value(spark, html) == "first"
    assert _value(spark, '<script>Operator</script><div class="font-semibold">first</div>') == "first"


def test_bounded_label_stays_in_its_scope(spark):
    html = (
        '<section><h2>Kurikulum</h2><b>Luas Tanah</b></section><div class="font-semibold">out</div>'
    )
    page = parsed(spark, html).selectExpr("nodes", f"{tree.section('nodes', 'Kurikulum')} AS s")
    found = page.select(
        value_by_label("nodes", "Luas Tanah", "s").alias("free"),
        value_by_label("nodes", "Luas Tanah", "s", bounded=True).alias("bounded"),
    ).first()
    assert (found.free, found.bounded) == ("out", None)
