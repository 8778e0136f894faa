"""Profile fields on hand-written pages."""

import pytest
from pages import evaluate, profile_of

from pagesift import fixed_values as fv
from pagesift.operators import older_profile
from pagesift.plans.render import SITE
from pagesift.sources.html_nodes import with_nodes


def test_empty_page_has_all_columns(spark):
    found = profile_of(spark, "<p>nothing</p>")
    assert list(found) == fv.PROFILE_COLUMNS
    assert {k for k, v in found.items() if v is not None} == {"url"}


def test_title_overrides_even_when_empty(spark):
    assert profile_of(spark, "<h1> </h1>", only="nama_sekolah")["nama_sekolah"] == ""


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<a href="https://{h}/npsn/1"> P1 </a>', "P1"),
        ('<a href="https://{h}/npsn/1">1</a><b>NPSN</b><div class="font-semibold">P2</div>', None),
        ('<a href="https://{h}/x">P1</a><b>NPSN</b><div class="font-semibold">p2</div>', "p2"),
        ('<b>NPSN</b><div class="font-semibold">2</div>', None),
        ('<a href="https://{h}/npsn/1"></a>', None),
    ],
)
def test_identifier(spark, html, expected):
    assert profile_of(spark, html.replace("{h}", SITE.registry_host), only="npsn")["npsn"] == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<div><i class="pi pi-phone"></i><a href="tel:1">0 1</a></div>', "0 1"),
        ('<div><i class="pi-phone"></i><a href="tel:"></a><b class="font-semibold">x</b></div>', ""),
        ('<div><i class="pi-phone"></i><b class="font-semibold">b</b><span class="font-semibold">s</span></div>', "s"),
        ('<div><i class="pi-phone"></i><span class="font-semibold">−</span></div>', None),
        ('<div><i class="pi-phone"></i></div><a href="tel:1">1</a>', None),
        ('<i class="pi-phone"></i><a href="tel:1">1</a>', "1"),
    ],
)
def test_phone(spark, html, expected):
    assert profile_of(spark, html, only="telepon")["telepon"] == expected


MAIL = '<a href="mailto:a">a@b</a>'


@pytest.mark.parametrize(
    "html, expected",
    [
        (f'<div><i class="pi-envelope"></i>{MAIL}</div>', "a@b"),
        (f'<div><p><i class="pi-envelope"></i></p>{MAIL}</div>', "a@b"),
        (f'<div><p><b><i class="pi-envelope"></i></b></p>{MAIL}</div>', "a@b"),
        ('<div><p><b><u><i class="pi-envelope"></i></u></b></p><a href="mailto:">x</a></div>', None),
        ('<a href="mailto:">Support@x</a><a href="mailto:">none</a><a href="mailto:">c@d</a>', "c@d"),
        (f'<p><i class="pi-envelope"></i><a href="mailto:">-</a></p>{MAIL}', "a@b"),
        (f'<p><i class="pi-envelope"></i><a href="mailto:"></a></p>{MAIL}', ""),
    ],
)
def test_email(spark, html, expected):
    assert profile_of(spark, html, only="email")["email"] == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ('<p><i class="pi-globe"></i><a href="/x">a</a><a href="http://y">b</a></p>', "http://y"),
        ('<p><i class="pi-globe"></i><div class="font-semibold">y.id</div></p>', "y.id"),
        ('<p><i class="pi-globe"></i><div class="font-semibold">Tidak Ada</div></p>', None),
    ],
)
def test_website(spark, html, expected):
    assert profile_of(spark, html, only="website")["website"] == expected


def test_licence_from_the_menu_only_without_an_id(spark):
    html = '<a href="/sk.pdf"><span class="p-menu-item-label">Unduh SK Operasional</span></a>'
    assert profile_of(spark, html, only="url_sk_operasional")["url_sk_operasional"] == "/sk.pdf"
    with_id = profile_of(spark, html, url="https://x/profil-sekolah/a-1")
    assert with_id["url_sk_operasional"] == SITE.document_base + "a-1.pdf"
    empty = '<a href=""><span class="p-menu-item-label">SK Operasional</span></a>'
    assert profile_of(spark, empty, only="url_sk_operasional")["url_sk_operasional"] is None


def _statistics(pairs, extra=""):
    body = "".join(
        f'<div class="text-2xl">{v}</div><div class="text-slate-600">{label}</div>' for label, v in pairs
    )
    return f"<div><h2>Statistik Sekolah</h2>{body}{extra}</div>"


def test_statistics_last_pair_wins_and_first_keyword_counts(spark):
    found = profile_of(
        spark,
        _statistics([("Guru", 1), ("Guru Kualifikasi", 2), ("GURU", 3), ("Siswa laki laki guru", 4), ("Rombel", "-")]),
    )
    assert (found["guru"], found["siswa_laki"], found["rombongan_belajar"]) == ("4", None, "-")


def test_statistics_are_cut_to_the_shorter_list(spark):
    found = profile_of(spark, _statistics([("Guru", 1)], '<div class="text-2xl">9</div>'))
    assert found["guru"] == "1"
    # a caption without a number shifts nothing but drops the last caption
    found = profile_of(spark, _statistics([], '<div class="text-slate-600">Guru</div><div class="text-slate-600">'
                                              'Perpustakaan</div><div class="text-2xl">5</div>'))
    assert (found["guru"], found["perpustakaan"]) == ("5", None)


def test_statistics_outside_the_section_do_not_count(spark):
    html = '<div class="text-2xl">8</div><div class="text-slate-600">Guru</div>' + _statistics([("Perpustakaan", 2)])
    found = profile_of(spark, html)
    assert (found["guru"], found["perpustakaan"]) == (None, "2")


def test_learning_items_need_both_parts(spark):
    item = '<li><div class="text-slate-600">{}</div>{}</li>'
    value = '<div class="font-semibold">{}</div>'
    html = "<section><h2>Proses Pembelajaran</h2>" + "".join(
        [
            item.format("Rasio Siswa Rombel", value.format("1,5")),
            item.format("Rasio Siswa Guru", ""),
            item.format("Persen Guru PNS", value.format("")),
            item.format("Ruang Kelas Layak", value.format("10 %")),
            item.format("Ruang Kelas Layak", value.format("20 %")),
        ]
    ) + "</section>"
    found = profile_of(spark, html)
    assert found["rasio_siswa_rombel"] == "1,5" and found["rasio_siswa_guru"] is None
    assert found["persen_guru_pns"] == "" and found["persen_ruang_kelas_layak"] == "20 %"


def test_utilities_read_past_their_section_unless_bounded(spark):
    html = '<div><h2>Kurikulum</h2><b>Luas Tanah</b></div><div class="font-semibold">next</div>'
    assert profile_of(spark, html, only="luas_tanah")["luas_tanah"] == "next"
    assert profile_of(spark, html, only="kurikulum")["kurikulum"] == "next"
    assert profile_of(spark, html, bounded=True, only="luas_tanah")["luas_tanah"] is None


FRAME = '<iframe src="https://m/?q=-6.5,106.7&z=1"></iframe>'
SHOWN = '<div><div>Lintang</div><div class="font-medium">-7</div></div><div><div>Bujur</div><div class="font-medium">110</div></div>'


@pytest.mark.parametrize(
    "body, expected",
    [
        (FRAME, ("-6.5", "106.7", fv.MAP_LINK + "-6.5,106.7")),
        (SHOWN, ("-7", "110", None)),
        (FRAME + SHOWN, ("-7", "110", fv.MAP_LINK + "-6.5,106.7")),
        ("<iframe></iframe>" + FRAME, (None, None, None)),
        ("", (None, None, None)),
        # a wrapper that holds nothing but the caption is found first; the search starts at its parent
        ('<div class="font-medium">0</div><div><div>Lintang</div></div><div class="font-medium">1</div>', ("0", None, None)),
    ],
)
def test_coordinates(spark, body, expected):
    found = profile_of(spark, f"<section><h2>Alamat</h2>{body}</section>")
    assert (found["lintang"], found["bujur"], found["link_google_map"]) == expected


def older(spark, html):
    pages = with_nodes(spark.createDataFrame([("u", html)], "url STRING, html STRING").coalesce(1))
    return older_profile.older_details(pages).first().asDict()


def test_older_cards_last_one_with_a_value_wins(spark):
    card = '<div class="rounded-xl">{}<div class="font-semibold">{}</div></div>'
    found = older(
        spark,
        card.format("Akreditasi", "A") + card.format("Akreditasi", "B") + '<div class="rounded">Akreditasi</div>',
    )
    assert found["akreditasi"] == "B" and found["url"] == "u"


def test_older_outer_card_sees_the_text_of_inner_ones(spark):
    found = older(
        spark,
        '<div class="rounded">Operator<div class="font-semibold">1</div>'
        '<div class="rounded">Operator<div class="font-semibold">2</div></div></div>',
    )
    assert found["operator"] == "2"


@pytest.mark.parametrize(
    "cards, expected",
    [
        ([("x", "1"), ("y", "2")], "1"),
        ([("x", "1"), ("Status", "2"), ("y", "3")], "2"),
        ([("x", "1"), ("Status", "-"), ("y", "3"), ("z", "4")], "3"),
        ([("Status", "1"), ("Status", "2")], "2"),
        ([("x", "-")], None),
        ([], None),
    ],
)
def test_older_status(spark, cards, expected):
    html = "".join(f'<div class="rounded">{w}<div class="font-semibold">{v}</div></div>' for w, v in cards)
    assert older(spark, html)["status_sekolah"] == expected


def test_older_links(spark):
    found = older(
        spark,
        '<div class="rounded">SK Operasional <a>no</a><a href="">x</a><a href="/2">y</a></div>'
        '<div class="rounded">Website <a href="/local">x</a><a href="http://w">y</a></div>'
        '<div class="rounded">Telepon <a href="tel:1">1</a></div><a href="https://maps.google.com/1">m</a>',
    )
    assert found["url_sk_operasional"] == "" and found["website"] is None
    assert found["telepon"] == "1" and found["link_google_map"] == "https://maps.google.com/1"


def test_older_text_after_label_needs_the_page_text(spark):
    assert older(spark, "<!-- Lintang --><div>1</div>")["lintang"] is None
    assert older(spark, "<!-- Lintang --><div>1</div><b>Lintang</b><div>2</div>")["lintang"] == "1"
    assert older(spark, "<p>Lintang</p><div> 2 </div>")["lintang"] == "2"


def test_older_statistics_are_page_wide(spark):
    html = '<div class="text-2xl">1</div><div class="text-slate-500">Guru Kualifikasi</div>'
    assert older(spark, html)["guru"] == "1"


def test_unreadable_profile_drops_out(spark):
    pages = with_nodes(spark.createDataFrame([("a", None), ("b", "<h1>x</h1>")], "url STRING, html STRING"))
    assert [r.url for r in older_profile.older_details(pages).collect()] == ["b"]


def test_evaluate_helper(spark):
    assert evaluate(spark, "<p>x</p>", "size(nodes)") == 2
