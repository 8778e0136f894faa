"""List cards on hand-written pages."""

from pages import parsed

from pagesift.operators import cards as cd

CARD = (
    '<article><span>NPSN : {id}</span><h3>{name}</h3>{status}'
    '<div class="line-clamp-1">l</div><div class="text-xs line-clamp-2">{place}</div></article>'
)


def rows(spark, *pages, record=cd.card_record):
    found = cd.card_rows(cd.with_cards(parsed(spark, *pages), record), "page_num")
    return [r.asDict() for r in found.orderBy("page_num", "pos").collect()]


def card(id="1", name="N", status='<div class="text-orange-600">S</div>', place="P"):
    return CARD.format(id=id, name=name, status=status, place=place)


def test_full_card(spark):
    assert rows(spark, card(name="A &amp; <b>B</b>")) == [
        {"page_num": 0, "pos": 0, "npsn": "1", "nama_sekolah": "A &B", "alamat_sekolah": "P", "status_sekolah": "S"}
    ]


def test_order_and_gaps_after_dropped_cards(spark):
    found = rows(spark, card("7") + card("-") + card("3"), card("9"), "<p>no cards</p>")
    assert [(r["page_num"], r["pos"], r["npsn"]) for r in found] == [(0, 0, "7"), (0, 2, "3"), (1, 0, "9")]


def test_status_layouts(spark):
    bold = '<div class="font-semibold">B</div>'
    both = bold + '<div class="text-orange-600">O</div>'
    empty = '<div class="text-orange-600"> </div>' + bold
    found = rows(spark, "".join(card(status=s) for s in (bold, both, empty, "")))
    assert [r["status_sekolah"] for r in found] == ["B", "O", None, None]


def test_first_string_with_the_marker_decides(spark):
    hidden = "<article><!-- NPSN --><b>NPSN : 5</b></article>"
    second = "<article><b>NPSN</b><b>NPSN : 5</b></article>"
    assert rows(spark, hidden + second) == []


def test_nested_and_unbalanced_markup(spark):
    found = rows(spark, "<article><p><b>NPSN : 1<h3>N</b> x</h3></article><article>NPSN : 2</article>")
    assert [(r["npsn"], r["nama_sekolah"]) for r in found] == [("1", "N"), ("2", None)]


def test_card_inside_a_card(spark):
    found = rows(spark, "<article><article>NPSN : 2</article>NPSN : 1</article>")
    assert [(r["pos"], r["npsn"]) for r in found] == [(0, "2"), (1, "2")]


def test_loose_record(spark):
    found = rows(
        spark,
        '<article>NPSN : 20 : 1<h3>N</h3><div class="font-semibold">F</div><div class="line-clamp-1">L</div></article>'
        "<article>NPSN :</article>",
        record=cd.loose_card_record("https://b"),
    )
    assert found == [
        {
            "page_num": 0, "pos": 0, "npsn": "20  1", "url": "https://b/profil-sekolah/20  1", "nama_sekolah": "N",
            "status_sekolah": "F", "alamat_jalan": "L",
        }
    ]


def test_published_columns(spark):
    frame = cd.card_rows(cd.with_cards(parsed(spark, card(status="", name=""))), "page_num")
    assert cd.published_cards(frame).collect() == [("1", "-", "P", "-")]


def test_unreadable_page_has_no_cards(spark):
    assert rows(spark, None, "", card()) == [
        {"page_num": 2, "pos": 0, "npsn": "1", "nama_sekolah": "N", "alamat_sekolah": "P", "status_sekolah": "S"}
    ]
