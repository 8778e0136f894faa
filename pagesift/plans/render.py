"""Directory pages rendered from the given tables, so that extraction can be checked against SQL.

Pages carry every layout the selectors must tell apart; which layout a row gets follows from its
own values (segment, region, balance). Nothing here is used by the extraction itself.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.config import SiteConfig
from pagesift.functions.text import quoted
from pagesift.sources.snapshots import spread_scan

SITE = SiteConfig()
PAGE_SIZE = 48


def markup(template: str, **values: str) -> str:
    """SQL text that fills the braces of an HTML template with expressions."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(quoted(literal))
        if name:
            parts.append(f"coalesce(CAST({values[name]} AS STRING), '')")
    return f"concat({', '.join(parts)})"


def escaped(value: str) -> str:
    return f"replace(replace(replace({value}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the names of their nation and region; both lookups have fixed, tiny size."""
    places = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey").join(
        table(spark, sf_dir, "region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = spread_scan(
        table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), "c_custkey"
    )
    return people.join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    return placed.join(customers(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))


# list pages ------------------------------------------------------------------------------------------

# the name is shown in two pieces, the status in one of four layouts, the marker in three spellings
STATUS_LAYOUT = (
    "CASE c_mktsegment"
    " WHEN 'BUILDING' THEN " + markup('<div class="font-semibold">{s}</div>', s="c_mktsegment")
    + " WHEN 'MACHINERY' THEN "
    + quoted('<div class="font-semibold">other</div><div class="p-1 text-orange-600"> </div>')
    + " WHEN 'FURNITURE' THEN '<div class=\"plain\">none</div>'"
    + " ELSE "
    + markup(
        '<div class="font-semibold">other</div><div class="text-orange-600 font-bold"> {s}\n</div>', s="c_mktsegment"
    )
    + " END"
)
MARKER = (
    "CASE r_name WHEN 'ASIA' THEN 'NPSN&nbsp;: ' WHEN 'EUROPE' THEN 'NPSN:' ELSE 'NPSN : ' END"
)


def card_html(marker: str = MARKER, status: str = STATUS_LAYOUT) -> str:
    return markup(
        '<article class="p-card"><!-- card -->\n<div class="head"><span>{marker}{key}</span></div>'
        '<h3>Customer <b>{tail}</b></h3>{status}<div class="line-clamp-2"><i class="pi"></i>near</div>'
        '<div class="mt-1 line-clamp-2 text-xs">{place} &amp; {region}</div>'
        '<button type="button"><span>Lihat</span></button></article>\n',
        marker=marker,
        key="c_custkey",
        tail="substring(c_name, 9)",
        status=status,
        place=escaped("n_name"),
        region=escaped("r_name"),
    )


def list_pages(cards: DataFrame, key: str, html: str, *page_facts) -> DataFrame:
    """``page_num, url, html`` of cards in the order of a unique key, 48 keys to a page."""
    framed = cards.selectExpr(
        f"CAST({key} div {PAGE_SIZE} AS INT) AS page_num", f"{key} AS _key", f"{html} AS _html", "*"
    )
    body = "array_join(transform(array_sort(collect_list(struct(_key, _html))), c -> c._html), '')"
    pages = framed.groupBy("page_num").agg(F.expr(body).alias("_body"), *page_facts)
    page = markup(
        "<!DOCTYPE html><html><head><title>Daftar</title><script>var NPSN = 1;</script></head>"
        "<body><main>{body}</main><footer>&copy; 2026</footer></body></html>",
        body="_body",
    )
    url = f"concat({quoted(SITE.base_url + '/sekolah?page=')}, page_num, '&size={PAGE_SIZE}')"
    return pages.selectExpr("page_num", f"{url} AS url", f"{page} AS html", "* EXCEPT (page_num, _body)")


def customer_pages(spark: SparkSession, sf_dir: str, **layout: str) -> DataFrame:
    return list_pages(customers(spark, sf_dir), "c_custkey", card_html(**layout))


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_pages(orders(spark, sf_dir), "o_orderkey", card_html())


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order pages as a crawl finds them: some time out, some hold no identifiers.

    A page fails when its first order is partial, and shows nothing when half of its orders are.
    """
    facts = [
        F.min_by("o_orderstatus", "o_orderkey").alias("first_status"),
        F.count_if(F.col("o_orderstatus") == "P").alias("n_partial"),
        F.min("o_orderkey").alias("first_order"),
    ]
    pages = list_pages(orders(spark, sf_dir), "o_orderkey", card_html(), *facts)
    return pages.selectExpr(
        "page_num",
        "url",
        "CASE WHEN n_partial >= 24 THEN replace(html, 'NPSN', 'Nomor') ELSE html END AS html",
        "first_status <> 'P' AS success",
        "timestamp_seconds(1704067200 + first_order) AS fetched_at",
    )


# profile pages ---------------------------------------------------------------------------------------

PROFILE_URL = (
    f"concat({quoted(SITE.base_url)}, CASE c_mktsegment WHEN 'FURNITURE' THEN '/profil-sekolah/x'"
    " WHEN 'HOUSEHOLD' THEN '/profil-sekolah/_' ELSE '/Profil-Sekolah/AB-' END, c_custkey)"
)


def _field(label: str, value: str) -> str:
    return markup(
        '<div class="item"><span class="text-sm">' + label + '</span>\n<div class="font-semibold">{v}</div></div>',
        v=value,
    )


def _by_region(africa: str, america: str, asia: str, europe: str, middle_east: str) -> str:
    return (
        f"CASE r_name WHEN 'AFRICA' THEN {africa} WHEN 'AMERICA' THEN {america} WHEN 'ASIA' THEN {asia}"
        f" WHEN 'EUROPE' THEN {europe} ELSE {middle_east} END"
    )


def _by_segment(automobile: str, building: str, furniture: str, household: str, machinery: str) -> str:
    return (
        f"CASE c_mktsegment WHEN 'AUTOMOBILE' THEN {automobile} WHEN 'BUILDING' THEN {building}"
        f" WHEN 'FURNITURE' THEN {furniture} WHEN 'HOUSEHOLD' THEN {household} ELSE {machinery} END"
    )


_TITLE = "CASE WHEN c_acctbal >= 0 THEN " + markup("<h1> {n}\n</h1>", n="c_name") + " END"
_MENU = (
    "CASE c_mktsegment WHEN 'FURNITURE' THEN "
    + markup(
        '<a href="/menu"><a href="/sk/{k}.pdf?a=1&amp;b=2"><i></i><span class="x p-menu-item-label">'
        "<b>SK Operasional</b></span></a></a>",
        k="c_custkey",
    )
    + " WHEN 'HOUSEHOLD' THEN "
    + quoted('<a href="/sk"><span class="p-menu-item-labels">SK Operasional</span></a>')
    + " END"
)
_REGISTRY = '<a href="https://' + SITE.registry_host + '/pendidikan/npsn/{k}">'
_ID = _by_region(
    markup(_REGISTRY + "\n P{k} <i></i></a>", k="c_custkey"),
    f"concat({markup(_REGISTRY + '{k}</a>', k='c_custkey')}, {_field('NPSN', 'concat(\"P\", c_custkey)')})",
    _field("NPSN", "concat('p', c_custkey)"),
    _field("NPSN", "c_custkey"),
    "''",
)
# every field of the grid has a layout in which its value is a sign for "nothing" or is left out
_GRID = ", ".join(
    [
        _field("Akreditasi", _by_segment("'A'", "'—'", "'−'", "'B &amp; C'", "' '")),
        _field("Status Sekolah", "CASE WHEN c_acctbal < 1000 THEN '‑' ELSE c_mktsegment END"),
        "CASE WHEN c_acctbal < 0 THEN '<span>Bentuk Pendidikan</span>' ELSE "
        + _field("Bentuk Pendidikan", "concat('B', c_nationkey)")
        + " END",
        _field("Kepala Sekolah", "concat('<b>Kepala </b>', c_custkey)"),
        _field("Operator", "n_name"),
        "CASE c_mktsegment WHEN 'MACHINERY' THEN '' ELSE " + _field("Yayasan", "r_name") + " END",
    ]
)
_PHONE = _by_segment(
    markup('<div><i class="pi pi-phone"></i><span class="font-semibold">x</span><a href="tel:{k}">0{k}</a></div>', k="c_custkey"),
    markup('<div><i class="pi pi-phone"></i><span class="font-semibold">+62 {k}</span></div>', k="c_custkey"),
    quoted('<div><i class="pi pi-phone"></i><a href="tel:">-</a></div>'),
    "''",
    quoted('<div><i class="pi pi-phone"></i><div class="font-semibold">―</div></div>'),
)
_MAIL = markup('<a href="mailto:{k}@x">{k}@mail.example</a>', k="c_custkey")
_EMAIL = _by_region(
    f"concat('<div><div><div><div><i class=\"pi-envelope\"></i>', {_MAIL}, '</div></div></div></div>')",
    f"concat('<div><div><div><div><i class=\"pi-envelope\"></i></div>', {_MAIL}, '</div></div></div>')",
    f"concat('<div><div><div><div><i class=\"pi-envelope\"></i></div></div>', {_MAIL}, '</div></div>')",
    "concat('<div><div><div><div><i class=\"pi-envelope\"></i></div></div></div>',"
    f" CASE WHEN c_acctbal >= 0 THEN {_MAIL} ELSE '' END, '</div>')",
    "'<div><i class=\"pi-envelope\"></i></div>'",
)
_WEB = _by_segment(
    markup('<div><i class="pi-globe"></i><a href="mailto:x">x</a><a href="https://s{k}.example/?a&amp;b">web</a></div>', k="c_custkey"),
    markup('<div><i class="pi-globe"></i><div class="font-semibold">s{k}.example</div></div>', k="c_custkey"),
    quoted('<div><i class="pi-globe"></i><div class="font-semibold">Belum Terisi</div></div>'),
    quoted('<div><i class="pi-globe"></i><div class="font-semibold">TIDAK ADA</div></div>'),
    quoted('<div><i class="pi-globe"></i><span>–</span></div>'),
)
_UTILITIES = (
    "concat('<section><h2><span>Kurikulum</span></h2>', "
    + ", ".join(
        [
            _field("Kurikulum", "concat('K', c_nationkey)"),
            _field("Penyelenggaraan", "c_mktsegment"),
            _field("Akses Internet", "CASE WHEN c_acctbal < 0 THEN '―' ELSE r_name END"),
            _field("Sumber Listrik", "concat('PLN &lt;', c_nationkey, '&gt;')"),
            _field("Daya Listrik", "CAST(c_custkey * 100 AS STRING)"),
            # without a value of its own the label reads on into the next section
            "CASE c_mktsegment WHEN 'BUILDING' THEN '<span>Luas Tanah</span>' ELSE "
            + _field("Luas Tanah", "CAST(c_custkey + 7 AS STRING)")
            + " END",
        ]
    )
    + ", '</section><div class=\"font-semibold\">beyond</div>')"
)
_FRAME = markup('<iframe src="https://maps.example/?q=-6.{k},106.{k}&amp;z=15"></iframe>', k="c_custkey")
_SHOWN = markup(
    '<div><div class="row"><div>Lintang</div><div class="font-medium"> -7.{k}</div></div>'
    '<div class="row"><div>Bujur</div><div class="font-medium">110.{k}</div></div></div>',
    k="c_custkey",
)
_ADDRESS = _by_region(
    f"concat('<section><h2>Alamat</h2>', {_FRAME}, '</section>')",
    f"concat('<section><h2>Alamat</h2>', {_SHOWN}, '</section>')",
    f"concat('<section><h2><b>Alamat</b></h2>', {_FRAME}, {_SHOWN}, '</section>')",
    f"concat('<section><h2><i></i> Alamat</h2>', {_FRAME}, {_SHOWN}, '</section>')",
    "'<section><h2>Alamat</h2><iframe></iframe></section>'",
)
PROFILE_HTML = (
    "concat_ws('', '<html><body>', "
    + ", ".join(
        [
            _TITLE,
            markup('<p class="mt-1 text-slate-600">{a}, {b}</p>', a="n_name", b="r_name"),
            _MENU,
            _ID,
            _GRID,
            _PHONE,
            _EMAIL,
            _WEB,
            _UTILITIES,
            _ADDRESS,
        ]
    )
    + ", '<footer><a href=\"mailto:s\">Support@portal.example</a></footer></body></html>')"
)


def profile_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile page per customer: ``url, html``."""
    return customers(spark, sf_dir).selectExpr(f"{PROFILE_URL} AS url", f"{PROFILE_HTML} AS html")


# profile pages with numbers ----------------------------------------------------------------------------


def supplier_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(
        spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus", "l_linenumber"
    )
    numbers = lines.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "A").alias("n_a"),
        F.count_if(F.col("l_returnflag") == "N").alias("n_n"),
        F.max("l_partkey").alias("max_part"),
        F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
        F.count_if(F.col("l_linestatus") == "O").alias("n_o"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_f"),
        F.max("l_linenumber").alias("max_line"),
    )
    suppliers = spread_scan(table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_acctbal"), "s_suppkey")
    return suppliers.join(numbers, F.col("s_suppkey") == F.col("l_suppkey"))


_STATISTICS = [
    ("Guru", "n_lines"),
    ("Persen guru kualifikasi", "concat(n_a * 100 div n_lines, ' %')"),
    ("Siswa Laki-laki", "n_a"),
    ("Siswa Perempuan", "n_n"),
    ("Rombongan Belajar", "max_part"),
    ("Daya Tampung", "quantity"),
    ("Jumlah Ruang Kelas", "n_o"),
    ("Laboratorium", "n_f"),
]
_LEARNING = [
    ("Rasio Siswa Rombel", "concat(n_lines, ',', n_a % 10)"),
    ("Rasio Rombel Ruang Kelas", "concat(n_o, '.', n_f % 10)"),
    ("Rasio Siswa Guru", "CASE WHEN s_acctbal < 0 THEN '-' ELSE CAST(n_lines AS STRING) END"),
    ("Guru Kualifikasi", "concat(n_a * 100 div n_lines, '%')"),
    ("Guru Sertifikasi", "concat(n_n * 100 div n_lines, ',5 %')"),
    ("Guru PNS", "concat(n_o * 100 div n_lines, '%')"),
    ("Ruang Kelas Layak", "concat(n_f * 100 div n_lines, '%')"),
]
SUPPLIER_URL = f"concat({quoted(SITE.base_url + '/profil-sekolah/')}, s_suppkey)"
SUPPLIER_HTML = (
    "concat_ws('', "
    + ", ".join(
        [
            markup("<body><h1>{n}</h1><section><h2>Statistik <!-- x -->Sekolah</h2></section>", n="s_name"),
            "'<section><h2>Statistik Sekolah</h2><div>'",
            *[
                markup(
                    '<div><div class="text-2xl font-bold">{v}</div>'
                    '<div class="text-slate-600 text-slate-500">' + label + "</div></div>",
                    v=value,
                )
                for label, value in _STATISTICS
            ],
            # a value whose label is missing for some is cut off with it
            markup('<div class="text-2xl">{v}</div>', v="max_line"),
            "CASE WHEN s_acctbal >= 2000 THEN"
            " '<div class=\"text-slate-600 text-slate-500\">Perpustakaan</div>' END",
            "'</div></section><section><h2>Proses Pembelajaran</h2><ul><li><div class=\"text-slate-600\">x</div></li>'",
            *[
                markup(
                    '<li><div><div class="text-slate-600">' + label + '</div></div><div class="font-semibold">{v}</div></li>',
                    v=value,
                )
                for label, value in _LEARNING
            ],
            "'</ul></section></body>'",
        ]
    )
    + ")"
)


def supplier_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_numbers(spark, sf_dir).selectExpr(f"{SUPPLIER_URL} AS url", f"{SUPPLIER_HTML} AS html")


# older profile pages -------------------------------------------------------------------------------------


def _rounded(body: str, **values: str) -> str:
    return markup('<div class="rounded-lg p-4">' + body + "</div>", **values)


OLDER_HTML = (
    "concat_ws('', "
    + ", ".join(
        [
            markup("<body><h1>{n}</h1>", n="c_name"),
            _rounded('<span>Alamat</span><div class="text-slate-600">{n}</div>', n="n_name"),
            _rounded('<span>Akreditasi</span> <div class="font-semibold">A{k}</div>', k="c_nationkey"),
            # a second card with the same word wins if it has a value
            _by_segment(
                _rounded('<span>Akreditasi</span> <div class="font-semibold">{k}</div>', k="c_mktsegment"),
                _rounded("<span>Akreditasi</span> <div>{k}</div>", k="c_mktsegment"),
                "''",
                "''",
                "''",
            ),
            _rounded('<b>SK</b> <b>Operasional</b><a href="/sk/{k}.pdf">x</a>', k="c_custkey"),
            _rounded('<b>No. Telp</b><a href="#">x</a><a href="tel:{k}">0{k}</a>', k="c_custkey"),
            _by_region(
                _rounded('<b>Website</b><a href="http://s{k}.example">x</a>', k="c_custkey"),
                _rounded('<b>Website</b><a href="/local">x</a><a href="http://s{k}.example">x</a>', k="c_custkey"),
                _rounded('<b>Status</b><div class="font-semibold">{r}</div>', r="r_name"),
                _rounded('<b>Kepala Sekolah</b><div class="font-semibold">H{k}</div>', k="c_custkey"),
                "''",
            ),
            _rounded('<b>Bentuk Pendidikan</b><div class="font-semibold">{s}</div>', s="c_mktsegment"),
            _rounded('<b>Operator</b><div class="font-semibold">O{k}</div><b>Yayasan</b>', k="c_custkey"),
            _rounded('<b>Email</b><a href="mailto:x">{k}@mail.example</a>', k="c_custkey"),
            "'<span>Kurikulum</span><div>x</div><div class=\"font-semibold\"> Merdeka </div>'",
            markup("<p><span>Lintang</span></p><p><span>Bujur</span><div>{k}.5</div></p>", k="c_custkey"),
            "CASE WHEN c_acctbal >= 0 THEN '<a href=\"https://maps.google.com/?q=1\">map</a>' END",
            "'</body>'",
        ]
    )
    + ")"
)


def older_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).selectExpr(f"{PROFILE_URL} AS url", f"{OLDER_HTML} AS html")
