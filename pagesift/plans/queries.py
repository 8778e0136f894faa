"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.config import RunConfig
from pagesift.functions import text as tx
from pagesift.operators import cards as cd
from pagesift.operators import merge, metrics, numbering, older_profile, pages, profile, shape
from pagesift.plans import render as rd
from pagesift.plans import run as runs
from pagesift.session import new_dir, stored, tune
from pagesift.sinks import files, table
from pagesift.sources import csv_files, page_plan, snapshots, state
from pagesift.sources.html_nodes import with_nodes
from pagesift.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BASE = rd.SITE.base_url
DOCUMENTS = rd.SITE.document_base

# SQL fragments the oracles share
PEOPLE = (
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
STATUS = "CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN NULL ELSE c_mktsegment END"
PLACE = "n_name || ' & ' || r_name"
PROFILE_URL = (
    f"'{BASE}' || CASE c_mktsegment WHEN 'FURNITURE' THEN '/profil-sekolah/x' "
    "WHEN 'HOUSEHOLD' THEN '/profil-sekolah/_' ELSE '/Profil-Sekolah/AB-' END || c_custkey"
)
CRAWL = """
    SELECT CAST(o_orderkey // 48 AS INTEGER) AS page_num, arg_min(o_orderstatus, o_orderkey) <> 'P' AS success,
           count(*) FILTER (o_orderstatus = 'P') < 24 AS filled, count(*) AS n, min(o_orderkey) AS first_order
    FROM orders GROUP BY ALL
"""
ORDER_CARDS = f"""
    SELECT CAST(o_orderkey // 48 AS INTEGER) AS page_num, CAST(o_orderkey % 48 AS INTEGER) AS pos,
           CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, {PLACE} AS alamat_sekolah,
           {STATUS} AS status_sekolah, o_orderkey
    FROM orders JOIN {PEOPLE} ON o_custkey = c_custkey
""".replace(f"JOIN {PEOPLE} ON o_custkey = c_custkey", f"JOIN ({PEOPLE}) ON o_custkey = c_custkey")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(tune(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql
        return run

    return register


def _text_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string") for c in columns])


# page plan and the given pages --------------------------------------------------------------------------


@query(
    f"""
    WITH size AS (SELECT CAST(ceil(count(*) / 48.0) AS BIGINT) AS n FROM orders)
    SELECT CAST(page AS INTEGER) AS page_num, '{BASE}/sekolah?page=' || page || '&size=48' AS url
    FROM size, unnest(range(3, least(3 + (n - 5), n))) AS pages(page) WHERE page <= n - 4
    """
)
def page_plan_limits(spark, sf_dir):
    """Plan for the pages that all orders fill, with a relative and an absolute limit."""
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    n = page_plan.page_count(total)
    config = RunConfig("plan", "", rd.SITE, start_page=3, max_pages=n - 5, last_page=n - 4, total_rows=total)
    return page_plan.page_plan(spark, config)


@query(
    """
    SELECT page_id, url, TRY_CAST(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INTEGER) AS page_num
    FROM pages
    """
)
def page_url_params(spark, sf_dir):
    found = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return found.withColumn("page_num", page_plan.page_number(F.col("url")))


def _given_pages(spark, sf_dir, *columns):
    return with_nodes(snapshots.read_pages(spark, f"{sf_dir}/pages.parquet", "page_id", "html", *columns))


@query(
    """
    WITH bare AS (SELECT page_id, regexp_replace(html, '<script>.*?</script>', '', 'gs') AS h FROM pages)
    SELECT page_id, CAST(len(regexp_extract_all(h, '<article[ >]')) AS INTEGER) AS n_articles,
           CAST(len(regexp_extract_all(h, '<a[ >]')) AS INTEGER) AS n_links,
           CAST(len(regexp_extract_all(h, '<div[ >]')) AS INTEGER) AS n_divs,
           CAST(len(regexp_extract_all(h, '<p[ >]')) AS INTEGER) AS n_paragraphs,
           CAST(len(regexp_extract_all(h, '<!--')) AS INTEGER) AS n_comments,
           CASE WHEN contains(h, '<article') THEN -1 ELSE 0 END AS probe
    FROM bare
    """
)
def page_nodes(spark, sf_dir):
    """Elements by tag on every given page, and the flag of the site probe."""
    counts = {"n_articles": "article", "n_links": "a", "n_divs": "div", "n_paragraphs": "p", "n_comments": "#comment"}
    probed = pages.site_probe(_given_pages(spark, sf_dir))
    return probed.selectExpr(
        "page_id", *[f"size(filter(nodes, n -> n.tag = '{tag}')) AS {name}" for name, tag in counts.items()], "probe"
    )


@query(
    """
    SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(
        regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
        '&amp;', '&'), '&amp$', '&'),
        E' \\n\\t') AS title
    FROM pages
    """
)
def page_title(spark, sf_dir):
    return _given_pages(spark, sf_dir).selectExpr("page_id", f"{profile.title('nodes')} AS title")


@query(
    """
    SELECT page_id, trim(replace(replace(replace(replace(
        regexp_extract(html, '<div class="ad">(.*?)</div>', 1, 's'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
        '&amp;', '&'),
        E' \\n\\t') AS block
    FROM pages
    """
)
def page_first_block(spark, sf_dir):
    from pagesift.functions import tree

    block = tree.text_of_first("nodes", tree.element("div", words=["ad"]))
    return _given_pages(spark, sf_dir).selectExpr("page_id", f"{block} AS block")


@query("SELECT page_id, CAST(0 AS INTEGER) AS n_rows, false AS ok FROM pages")
def page_without_cards(spark, sf_dir):
    """The given pages hold articles without an identifier: read, but every one counts as failed."""
    read = cd.with_cards(_given_pages(spark, sf_dir).withColumn("success", F.lit(True)))
    return pages.with_outcome(read).select("page_id", "n_rows", "ok")


# list cards ---------------------------------------------------------------------------------------------


def _customer_cards(spark, sf_dir, record=cd.card_record, **layout):
    read = with_nodes(rd.customer_pages(spark, sf_dir, **layout).select("page_num", "html"))
    return cd.card_rows(cd.with_cards(read, record), "page_num")


@query(
    f"""
    SELECT CAST(c_custkey // 48 AS INTEGER) AS page_num, CAST(c_custkey % 48 AS INTEGER) AS pos,
           CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, {PLACE} AS alamat_sekolah,
           {STATUS} AS status_sekolah
    FROM {PEOPLE}
    """
)
def card_extract(spark, sf_dir):
    return _customer_cards(spark, sf_dir)


@query(
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, {PLACE} AS alamat_sekolah,
           coalesce({STATUS}, '-') AS status_sekolah
    FROM {PEOPLE}
    """
)
def card_publish(spark, sf_dir):
    """The four columns in order with gaps marked."""
    return cd.published_cards(_customer_cards(spark, sf_dir))


LOOSE_MARKER = "CASE WHEN c_acctbal < 0 THEN ':: NPSN' ELSE 'NPSN : ' END"


@query(
    f"""
    SELECT CAST(c_custkey // 48 AS INTEGER) AS page_num, CAST(c_custkey % 48 AS INTEGER) AS pos,
           CAST(c_custkey AS VARCHAR) AS npsn, '{BASE}/profil-sekolah/' || c_custkey AS url, c_name AS nama_sekolah,
           CASE c_mktsegment WHEN 'BUILDING' THEN c_mktsegment WHEN 'FURNITURE' THEN NULL ELSE 'other' END
               AS status_sekolah,
           'near' AS alamat_jalan
    FROM {PEOPLE}
    """
)
def card_loose(spark, sf_dir):
    return _customer_cards(spark, sf_dir, cd.loose_card_record(BASE), marker=LOOSE_MARKER)


NO_ID_MARKER = "CASE WHEN c_acctbal < 0 THEN '<!-- NPSN --> NPSN : ' WHEN c_acctbal < 500 THEN 'NPSN - ' ELSE 'NPSN : ' END"


@query(
    f"""
    SELECT CAST(c_custkey // 48 AS INTEGER) AS page_num, CAST(c_custkey % 48 AS INTEGER) AS pos,
           CAST(c_custkey AS VARCHAR) AS npsn, '{BASE}/profil-sekolah/' || c_custkey AS url,
           c_name AS nama_sekolah, {STATUS} AS status_sekolah, {PLACE} AS alamat_jalan
    FROM {PEOPLE} WHERE c_acctbal >= 500 AND c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
    """
)
def card_filter(spark, sf_dir):
    """Cards that show an identifier and led to a profile when they were opened."""
    cards = _customer_cards(spark, sf_dir, marker=NO_ID_MARKER)
    opened = rd.customers(spark, sf_dir).selectExpr(
        f"CAST(c_custkey div {rd.PAGE_SIZE} AS INT) AS page_num",
        f"CAST(c_custkey % {rd.PAGE_SIZE} AS INT) AS pos",
        f"concat('{BASE}/sekolah?page=', c_custkey div {rd.PAGE_SIZE}) AS list_url",
        f"CASE c_mktsegment WHEN 'MACHINERY' THEN concat('{BASE}/sekolah?page=', c_custkey div {rd.PAGE_SIZE})"
        f" WHEN 'BUILDING' THEN '{BASE}/login' ELSE concat('{BASE}/profil-sekolah/', c_custkey) END AS observed_url",
    )
    return cd.opened_cards(cards, opened, ["page_num", "pos"])


def _order_cards(spark, sf_dir):
    read = with_nodes(rd.order_pages(spark, sf_dir).select("page_num", "html"))
    return cd.card_rows(cd.with_cards(read), "page_num")


@query(
    f"""
    SELECT npsn, nama_sekolah, alamat_sekolah, status_sekolah, page_num, pos FROM ({ORDER_CARDS})
    QUALIFY row_number() OVER (PARTITION BY npsn ORDER BY page_num, pos) = 1
    """
)
def card_dedup_first(spark, sf_dir):
    """First card of every identifier over the pages of all orders."""
    return shape.keep_first(_order_cards(spark, sf_dir)).select(*fv.CARD_COLUMNS, "page_num", "pos")


# profile fields -------------------------------------------------------------------------------------------


def _profile_fields(spark, sf_dir, names, bounded=False):
    read = with_nodes(rd.profile_pages(spark, sf_dir))
    fields = profile.field_expressions(rd.SITE, bounded)
    return profile.with_blocks(read).selectExpr("url", *[f"{fields[n]} AS {n}" for n in names])


AKREDITASI = "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'HOUSEHOLD' THEN 'B & C' END"
LABELS_SQL = f"""
    {AKREDITASI} AS akreditasi,
    CASE WHEN c_acctbal >= 1000 THEN c_mktsegment END AS status_sekolah,
    CASE WHEN c_acctbal < 0 THEN 'Kepala' || c_custkey ELSE 'B' || c_nationkey END AS bentuk_pendidikan,
    'Kepala' || c_custkey AS kepala_sekolah, n_name AS operator,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN r_name END AS yayasan
"""
UTILITIES_SQL = """
    'K' || c_nationkey AS kurikulum, c_mktsegment AS penyelenggaraan,
    CASE WHEN c_acctbal >= 0 THEN r_name END AS akses_internet,
    'PLN <' || c_nationkey || '>' AS sumber_listrik, CAST(c_custkey * 100 AS VARCHAR) AS daya_listrik,
    CASE c_mktsegment WHEN 'BUILDING' THEN {beyond} ELSE CAST(c_custkey + 7 AS VARCHAR) END AS luas_tanah
"""
NPSN_SQL = "CASE r_name WHEN 'AFRICA' THEN 'P' || c_custkey WHEN 'ASIA' THEN 'p' || c_custkey END"
CONTACTS_SQL = """
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '0' || c_custkey WHEN 'BUILDING' THEN '+62 ' || c_custkey
        WHEN 'FURNITURE' THEN '-' END AS telepon,
    CASE r_name WHEN 'MIDDLE EAST' THEN
            CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'x' ELSE 'Support@portal.example' END
        WHEN 'EUROPE' THEN CASE WHEN c_acctbal >= 0 THEN c_custkey || '@mail.example' END
        ELSE c_custkey || '@mail.example' END AS email,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'https://s' || c_custkey || '.example/?a&b'
        WHEN 'BUILDING' THEN 's' || c_custkey || '.example' END AS website
"""
DOCUMENT_SQL = f"""
    CASE c_mktsegment WHEN 'FURNITURE' THEN '/sk/' || c_custkey || '.pdf?a=1&b=2' WHEN 'HOUSEHOLD' THEN NULL
        ELSE '{DOCUMENTS}AB-' || c_custkey || '.pdf' END AS url_sk_operasional
"""
COORDINATES_SQL = f"""
    CASE r_name WHEN 'AFRICA' THEN '-6.' || c_custkey WHEN 'AMERICA' THEN '-7.' || c_custkey
        WHEN 'ASIA' THEN '-7.' || c_custkey END AS lintang,
    CASE r_name WHEN 'AFRICA' THEN '106.' || c_custkey WHEN 'AMERICA' THEN '110.' || c_custkey
        WHEN 'ASIA' THEN '110.' || c_custkey END AS bujur,
    CASE WHEN r_name IN ('AFRICA', 'ASIA') THEN '{fv.MAP_LINK}-6.' || c_custkey || ',106.' || c_custkey END
        AS link_google_map
"""


@query(f"SELECT {PROFILE_URL} AS url, {LABELS_SQL}, {UTILITIES_SQL.format(beyond=chr(39) + 'beyond' + chr(39))} FROM {PEOPLE}")
def label_values(spark, sf_dir):
    """Labelled fields, with placeholders, missing labels and values read on from the next field."""
    return _profile_fields(spark, sf_dir, [*fv.PROFILE_LABELS, *fv.UTILITY_LABELS])


@query(f"SELECT {PROFILE_URL} AS url, {UTILITIES_SQL.format(beyond='NULL')} FROM {PEOPLE}")
def label_values_bounded(spark, sf_dir):
    """The utilities block when labels may not read past their section."""
    return _profile_fields(spark, sf_dir, [*fv.UTILITY_LABELS], bounded=True)


@query(f"SELECT {PROFILE_URL} AS url, {NPSN_SQL} AS npsn FROM {PEOPLE}")
def id_reconcile(spark, sf_dir):
    return _profile_fields(spark, sf_dir, ["npsn"])


@query(f"SELECT {PROFILE_URL} AS url, {CONTACTS_SQL} FROM {PEOPLE}")
def contacts(spark, sf_dir):
    return _profile_fields(spark, sf_dir, ["telepon", "email", "website"])


@query(f"SELECT {PROFILE_URL} AS url, {DOCUMENT_SQL} FROM {PEOPLE}")
def doc_url(spark, sf_dir):
    return _profile_fields(spark, sf_dir, ["url_sk_operasional"])


@query(f"SELECT {PROFILE_URL} AS url, {COORDINATES_SQL} FROM {PEOPLE}")
def coordinates(spark, sf_dir):
    return _profile_fields(spark, sf_dir, ["lintang", "bujur", "link_google_map"])


@query(
    f"""
    SELECT {PROFILE_URL} AS url, CASE WHEN c_acctbal >= 0 THEN c_name END AS nama_sekolah,
           n_name || ', ' || r_name AS alamat_sekolah
    FROM {PEOPLE}
    """
)
def title_and_address(spark, sf_dir):
    return _profile_fields(spark, sf_dir, ["nama_sekolah", "alamat_sekolah"])


SUPPLIERS = """
    supplier JOIN (
        SELECT l_suppkey, count(*) AS n_lines, count(*) FILTER (l_returnflag = 'A') AS n_a,
               count(*) FILTER (l_returnflag = 'N') AS n_n, max(l_partkey) AS max_part,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
               count(*) FILTER (l_linestatus = 'O') AS n_o, count(*) FILTER (l_linestatus = 'F') AS n_f,
               max(l_linenumber) AS max_line
        FROM lineitem GROUP BY l_suppkey) ON s_suppkey = l_suppkey
"""
SUPPLIER_URL = f"'{BASE}/profil-sekolah/' || s_suppkey"
STATISTICS_SQL = """
    CAST({guru} AS VARCHAR) AS guru, CAST(n_a AS VARCHAR) AS siswa_laki, CAST(n_n AS VARCHAR) AS siswa_perempuan,
    CAST(max_part AS VARCHAR) AS rombongan_belajar, CAST(quantity AS VARCHAR) AS daya_tampung,
    CAST(n_o AS VARCHAR) AS ruang_kelas, CAST(n_f AS VARCHAR) AS laboratorium,
    CASE WHEN s_acctbal >= 2000 THEN CAST(max_line AS VARCHAR) END AS perpustakaan
"""
LEARNING_SQL = """
    n_lines || ',' || n_a % 10 AS rasio_siswa_rombel, n_o || '.' || n_f % 10 AS rasio_rombel_ruang_kelas,
    CASE WHEN s_acctbal < 0 THEN '-' ELSE CAST(n_lines AS VARCHAR) END AS rasio_siswa_guru,
    n_a * 100 // n_lines || '%' AS persen_guru_kualifikasi, n_n * 100 // n_lines || ',5 %' AS persen_guru_sertifikasi,
    n_o * 100 // n_lines || '%' AS persen_guru_pns, n_f * 100 // n_lines || '%' AS persen_ruang_kelas_layak
"""


def _supplier_fields(spark, sf_dir, names):
    read = with_nodes(rd.supplier_pages(spark, sf_dir))
    fields = profile.field_expressions(rd.SITE)
    return profile.with_blocks(read).selectExpr("url", *[f"{fields[n]} AS {n}" for n in names])


@query(f"SELECT {SUPPLIER_URL} AS url, {STATISTICS_SQL.format(guru='n_lines')} FROM {SUPPLIERS}")
def stat_block(spark, sf_dir):
    return _supplier_fields(spark, sf_dir, [n for n, _, _ in fv.STATISTIC_KEYWORDS])


OLDER_GURU = "n_a * 100 // n_lines || ' %'"


@query(f"SELECT {SUPPLIER_URL} AS url, {STATISTICS_SQL.format(guru=OLDER_GURU)} FROM {SUPPLIERS}")
def stat_block_older(spark, sf_dir):
    """The page-wide form: a caption about qualified teachers overwrites their number."""
    return older_profile.older_details(with_nodes(rd.supplier_pages(spark, sf_dir))).select(
        "url", *[n for n, _, _ in fv.OLDER_STATISTIC_KEYWORDS]
    )


@query(f"SELECT {SUPPLIER_URL} AS url, {LEARNING_SQL} FROM {SUPPLIERS}")
def learning_list(spark, sf_dir):
    return _supplier_fields(spark, sf_dir, [n for n, _, _ in fv.LEARNING_KEYWORDS])


OLDER_SQL = f"""
    c_name AS nama_sekolah, n_name AS alamat_sekolah, '/sk/' || c_custkey || '.pdf' AS url_sk_operasional,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN c_mktsegment ELSE 'A' || c_nationkey END AS akreditasi,
    CASE r_name WHEN 'EUROPE' THEN 'H' || c_custkey END AS kepala_sekolah, '0' || c_custkey AS telepon,
    CASE r_name WHEN 'AFRICA' THEN 'http://s' || c_custkey || '.example' END AS website,
    CASE r_name WHEN 'ASIA' THEN r_name ELSE 'A' || c_nationkey END AS status_sekolah,
    c_mktsegment AS bentuk_pendidikan, 'O' || c_custkey AS operator, c_custkey || '@mail.example' AS email,
    'O' || c_custkey AS yayasan, 'Merdeka' AS kurikulum, c_custkey || '.5' AS lintang, c_custkey || '.5' AS bujur,
    CASE WHEN c_acctbal >= 0 THEN 'https://maps.google.com/?q=1' END AS link_google_map
"""
OLDER_FIELDS = [
    "nama_sekolah", "alamat_sekolah", "url_sk_operasional", "akreditasi", "kepala_sekolah", "telepon", "website",
    "status_sekolah", "bentuk_pendidikan", "operator", "email", "yayasan", "kurikulum", "lintang", "bujur",
    "link_google_map",
]


@query(f"SELECT {PROFILE_URL} AS url, {OLDER_SQL} FROM {PEOPLE}")
def keyword_cards(spark, sf_dir):
    """The older layout: cards told apart by their words, page-wide curriculum, coordinates and map link."""
    return older_profile.older_details(with_nodes(rd.older_pages(spark, sf_dir))).select("url", *OLDER_FIELDS)


# list and profile merged ------------------------------------------------------------------------------------


def _listed(spark, sf_dir, record_order=True):
    """Cards of all orders with the profile URL of their customer; some have none."""
    cards = _order_cards(spark, sf_dir).withColumnRenamed("alamat_sekolah", "alamat_jalan")
    links = rd.customers(spark, sf_dir).selectExpr(
        "CAST(c_custkey AS STRING) AS npsn",
        f"CASE WHEN c_acctbal BETWEEN 500 AND 600 THEN NULL ELSE {rd.PROFILE_URL} END AS url",
    )
    return cards.join(links, "npsn")


MERGE_SOURCE = f"""
    (SELECT page_num, pos, npsn, nama_sekolah AS list_name, status_sekolah AS list_status,
            alamat_sekolah AS list_address FROM ({ORDER_CARDS})) AS cards
    JOIN ({PEOPLE}) ON npsn = CAST(c_custkey AS VARCHAR)
    WHERE NOT c_acctbal BETWEEN 500 AND 600
"""
NO_STATISTICS = ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n, _, _ in fv.STATISTIC_KEYWORDS + fv.LEARNING_KEYWORDS)
LABELS_AS_DETAIL = LABELS_SQL.replace("AS status_sekolah", "AS detail_status").replace("AS npsn", "AS detail_npsn")


@query(
    f"""
    SELECT page_num, pos, * EXCLUDE (page_num, pos, detail_status, list_status) REPLACE (),
           coalesce(detail_status, list_status) AS status_sekolah
    FROM (
        SELECT page_num, pos, coalesce({NPSN_SQL}, npsn) AS npsn, {PROFILE_URL} AS url,
               CASE WHEN c_acctbal >= 0 THEN c_name ELSE list_name END AS nama_sekolah,
               n_name || ', ' || r_name AS alamat_sekolah, list_address AS alamat_jalan, list_status,
               {DOCUMENT_SQL}, {LABELS_AS_DETAIL}, {CONTACTS_SQL},
               {UTILITIES_SQL.format(beyond=chr(39) + 'beyond' + chr(39))}, {NO_STATISTICS}, {COORDINATES_SQL}
        FROM {MERGE_SOURCE})
    """.replace(" REPLACE ()", "")
)
def profile_merge_detail_first(spark, sf_dir):
    """All 39 columns of every card with a profile: the profile wins, the card fills the gaps."""
    details = profile.profile_details(with_nodes(rd.profile_pages(spark, sf_dir)), rd.SITE)
    return merge.merge_detail_first(
        stored(_listed(spark, sf_dir), "cards"), stored(details, "details"), "page_num", "pos"
    )


OLDER_MISSING = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}"
    for c in fv.PROFILE_COLUMNS
    if c not in OLDER_FIELDS and c not in ("npsn", "url", "alamat_jalan")
)


@query(
    f"""
    SELECT * EXCLUDE (list_status, list_name, older_name, older_status),
           coalesce(list_status, older_status) AS status_sekolah, coalesce(list_name, older_name) AS nama_sekolah
    FROM (
        SELECT page_num, pos, npsn, {PROFILE_URL} AS url, list_status, list_name,
               coalesce(list_address, n_name) AS alamat_jalan,
               {OLDER_SQL.replace("AS nama_sekolah", "AS older_name").replace("AS status_sekolah", "AS older_status")},
               {OLDER_MISSING}
        FROM {MERGE_SOURCE})
    """
)
def profile_merge_list_first(spark, sf_dir):
    """All 39 columns: the card wins, the older profile page fills the gaps."""
    details = older_profile.older_details(with_nodes(rd.older_pages(spark, sf_dir)))
    return merge.merge_list_first(
        stored(_listed(spark, sf_dir), "cards"), stored(details, "details"), "page_num", "pos"
    )


# page outcomes, resume, retry ---------------------------------------------------------------------------------


def _crawl(spark, sf_dir):
    """Outcome and cards of the first fetch of every order page."""
    return runs.page_results(rd.crawled_pages(spark, sf_dir))


@query(
    f"""
    SELECT page_num, success, CAST(CASE WHEN success AND filled THEN n ELSE 0 END AS INTEGER) AS n_rows,
           success AND filled AS ok,
           CASE WHEN NOT success THEN 'not loaded' WHEN NOT filled THEN 'no rows' END AS error
    FROM ({CRAWL})
    """
)
def page_outcome(spark, sf_dir):
    return _crawl(spark, sf_dir).select("page_num", "success", "n_rows", "ok", "error")


@query(f"SELECT page_num, count(*) AS n_rows FROM ({ORDER_CARDS}) GROUP BY page_num")
def rows_per_page(spark, sf_dir):
    return metrics.rows_per_page(_order_cards(spark, sf_dir))


@query(
    f"""
    WITH size AS (SELECT CAST(ceil(count(*) / 48.0) AS BIGINT) + 2 AS n FROM orders),
         plan AS (SELECT CAST(page AS INTEGER) AS page_num FROM size, unnest(range(0, n)) AS pages(page))
    SELECT page_num, '{BASE}/sekolah?page=' || page_num || '&size=48' AS url FROM plan
    WHERE page_num NOT IN (SELECT page_num FROM ({CRAWL}) WHERE success AND filled)
    """
)
def page_pending(spark, sf_dir):
    """Planned pages that the first pass did not bring in; the plan has two pages nobody fetched."""
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    config = RunConfig("plan", "", rd.SITE, total_rows=(page_plan.page_count(total) + 2) * fv.PAGE_SIZE)
    status = _crawl(spark, sf_dir).select("page_num", "ok")
    return pages.pending_pages(page_plan.page_plan(spark, config), status)


def _retried(spark, sf_dir):
    """The failed pages of the first pass, fetched again: timeouts are gone, empty pages stay empty."""
    snapshot = rd.crawled_pages(spark, sf_dir)
    first = stored(_crawl(spark, sf_dir), "first")
    again = pages.without_done(snapshot.withColumn("success", F.lit(True)), first.select("page_num", "ok"))
    return first, stored(runs.page_results(again), "again")


@query(
    f"""
    SELECT cards.page_num, pos, npsn, nama_sekolah, alamat_sekolah, status_sekolah
    FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE filled
    """
)
def retry_merge(spark, sf_dir):
    """Rows of the first pass and of the retry of its failed pages."""
    first, again = _retried(spark, sf_dir)
    return pages.with_retried(
        cd.card_rows(first.where("ok"), "page_num"), cd.card_rows(again.where("ok"), "page_num")
    )


@query(
    f"""
    SELECT count(*) FILTER (NOT (success AND filled)) AS retried,
           count(*) FILTER (NOT success AND filled) AS recovered, count(*) FILTER (NOT filled) AS remaining
    FROM ({CRAWL})
    """
)
def retry_yield(spark, sf_dir):
    first, again = _retried(spark, sf_dir)
    return metrics.retry_yield(first.where("NOT ok"), again)


@query(f"SELECT page_num FROM ({CRAWL}) WHERE NOT filled")
def still_failed(spark, sf_dir):
    first, again = _retried(spark, sf_dir)
    return pages.still_failed(first.where("NOT ok").select("page_num"), again)


@query(
    f"""
    WITH crawl AS ({CRAWL})
    SELECT page_num, CAST(CASE WHEN success AND filled THEN n ELSE 0 END AS INTEGER) AS n_rows FROM crawl
    WHERE page_num < (SELECT coalesce(min(page_num), 2147483647) FROM crawl WHERE success AND NOT filled)
    """
)
def empty_stop(spark, sf_dir):
    """Pages before the first one that was read and held nothing."""
    outcomes = stored(_crawl(spark, sf_dir).select("page_num", "success", "n_rows"), "outcomes")
    return pages.until_empty_page(outcomes).drop("success")


def _order_results(spark, sf_dir):
    """Order pages with their cards, written once as a run writes them."""
    pages_read = rd.order_pages(spark, sf_dir).withColumn("success", F.lit(True)).withColumn("fetched_at", F.lit(None).cast("timestamp"))
    return stored(runs.page_results(pages_read).select("page_num", "n_rows", "cards"), "order-pages")


# numbering and batches ------------------------------------------------------------------------------------------

NUMBERED = f"SELECT *, row_number() OVER (ORDER BY page_num, pos) AS row_num FROM ({ORDER_CARDS})"
LABEL = "'batch_' || ((row_num - 1) // {s} * {s} + 1) || '-' || {high}"


@query(
    f"""
    WITH numbered AS ({NUMBERED}), total AS (SELECT count(*) AS n FROM numbered)
    SELECT page_num, pos, npsn, row_num, (row_num - 1) // 100 AS batch_id,
           {LABEL.format(s=100, high='least((row_num - 1) // 100 * 100 + 100, n)')} AS batch_label
    FROM numbered, total
    """
)
def batch_rows(spark, sf_dir):
    rows = numbering.batched_pages(_order_results(spark, sf_dir), fv.LIST_BATCH_SIZE)
    return rows.select("page_num", "pos", "npsn", "row_num", "batch_id", "batch_label")


@query(
    f"""
    WITH numbered AS ({NUMBERED})
    SELECT (row_num - 1) // 50 AS batch_id, {LABEL.format(s=50, high='((row_num - 1) // 50 * 50 + 50)')} AS batch_label,
           count(*) AS n_rows, min(row_num) AS first_row, max(row_num) AS last_row
    FROM numbered GROUP BY ALL
    """
)
def batch_manifest(spark, sf_dir):
    return numbering.batch_manifest(numbering.batched_pages(_order_results(spark, sf_dir), fv.PROFILE_BATCH_SIZE, clip=False))


@query(
    f"""
    WITH numbered AS ({NUMBERED}), total AS (SELECT count(*) AS n FROM numbered)
    SELECT {LABEL.format(s=100, high='least((row_num - 1) // 100 * 100 + 100, n)')} AS batch, npsn, nama_sekolah,
           alamat_sekolah, coalesce(status_sekolah, '-') AS status_sekolah
    FROM numbered, total
    """
)
def batch_files(spark, sf_dir):
    """Batch CSV files written and read back with their labels."""
    path = files.write_batches(numbering.batched_pages(_order_results(spark, sf_dir)), new_dir(spark, "batches"))
    return csv_files.read_published_csv(spark, path, [*fv.CARD_COLUMNS, "batch"])


@query(
    f"""
    WITH numbered AS ({NUMBERED})
    SELECT 'batches_' || ((row_num - 1) // 1600 * 16) || '-' || ((row_num - 1) // 1600 * 16 + 15) AS batch,
           {LABEL.format(s=100, high='((row_num - 1) // 100 * 100 + 100)')} AS batch_label, npsn
    FROM numbered
    """
)
def batch_files_packed(spark, sf_dir):
    """Sixteen batches to a folder."""
    rows = numbering.batched_pages(_order_results(spark, sf_dir), clip=False).drop("nama_sekolah", "alamat_sekolah", "status_sekolah")
    path = files.write_batches(rows, new_dir(spark, "batches"), 16)
    return csv_files.read_published_csv(spark, path, ["npsn", "batch_label", "batch"])


# metrics ----------------------------------------------------------------------------------------------------------

EVENT_STATUS = (
    "CAST(event_id AS INT) AS page_num",
    "event_type <> 'error' AS ok",
    "CASE WHEN event_type <> 'error' THEN CAST(user_id AS INT) ELSE 0 END AS n_rows",
    "ts",
)


def _event_status(spark, sf_dir):
    return rd.table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "ts").selectExpr(*EVENT_STATUS)


@query(
    """
    WITH totals AS (
        SELECT CAST(sum(CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END) AS BIGINT) AS total_rows,
               count(*) AS pages_planned, count(*) FILTER (event_type <> 'error') AS pages_ok,
               count(*) FILTER (event_type = 'error') AS pages_failed,
               CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS elapsed_seconds
        FROM events)
    SELECT *, CAST(pages_ok AS DOUBLE) * 100 / pages_planned AS progress_percent,
           elapsed_seconds / 60 AS elapsed_minutes, total_rows / elapsed_seconds AS rows_per_second
    FROM totals
    """
)
def run_metrics(spark, sf_dir):
    """Totals, progress and rate, with the events as page outcomes."""
    return metrics.run_totals(_event_status(spark, sf_dir))


WIDTH_COLUMNS = ["npsn", "nama_sekolah", "alamat_sekolah", "status_sekolah"]


@query(
    f"""
    WITH cards AS (SELECT CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, {PLACE} AS alamat_sekolah,
                          coalesce({STATUS}, '-') AS status_sekolah FROM {PEOPLE})
    SELECT column_name, CAST(least(greatest(max(length(cell)), max(length(column_name))) + 2, 100) AS INTEGER) AS width
    FROM (UNPIVOT cards ON npsn, nama_sekolah, alamat_sekolah, status_sekolah INTO NAME column_name VALUE cell)
    GROUP BY column_name
    """
)
def column_widths(spark, sf_dir):
    return metrics.column_widths(_customer_cards(spark, sf_dir).select(*fv.CARD_COLUMNS))


@query(
    f"""
    WITH found AS (SELECT * FROM (SELECT {PROFILE_URL} AS url, {LABELS_SQL}, {CONTACTS_SQL}, {DOCUMENT_SQL},
                                         {COORDINATES_SQL} FROM {PEOPLE})),
         cells AS (SELECT column_name, cell FROM found UNPIVOT INCLUDE NULLS (cell FOR column_name IN (*)))
    SELECT column_name, count(*) AS n_rows, count(*) FILTER (cell IS NULL OR cell = '-') AS n_missing,
           CAST(count(*) FILTER (cell IS NULL OR cell = '-') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS missing_share
    FROM cells GROUP BY column_name
    """
)
def completeness(spark, sf_dir):
    """Share of missing cells in the profile fields of all customers."""
    names = [
        *fv.PROFILE_LABELS, "telepon", "email", "website", "url_sk_operasional", "lintang", "bujur", "link_google_map",
    ]
    return metrics.completeness(_profile_fields(spark, sf_dir, names))


# shapes ---------------------------------------------------------------------------------------------------------


@query(
    """
    SELECT 'c' || c_custkey AS npsn, c_mktsegment AS status_sekolah, '-' AS operator, c_name AS nama_sekolah, '-' AS guru
    FROM customer
    UNION ALL BY NAME
    SELECT 's' || s_suppkey AS npsn, '-' AS status_sekolah, s_name AS operator, '-' AS nama_sekolah,
           CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS VARCHAR) ELSE '-' END AS guru
    FROM supplier
    """
)
def schema_union(spark, sf_dir):
    """Records with different keys under the sorted union of all keys."""
    people = rd.table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment").selectExpr(
        "concat('c', c_custkey) AS npsn", "c_name AS nama_sekolah", "c_mktsegment AS status_sekolah"
    )
    firms = rd.table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal").selectExpr(
        "s_name AS operator", "CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS STRING) END AS guru",
        "concat('s', s_suppkey) AS npsn",
    )
    return shape.union_of_keys([people, firms])


@query(
    "SELECT CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, "
    + ", ".join(f"'-' AS {c}" for c in fv.PROFILE_COLUMNS if c not in ("npsn", "nama_sekolah"))
    + " FROM customer"
)
def row_alignment(spark, sf_dir):
    """Short records laid out under all 39 columns."""
    short = rd.table(spark, sf_dir, "customer", "c_custkey", "c_name").selectExpr(
        "c_name AS nama_sekolah", "CAST(c_custkey AS STRING) AS npsn"
    )
    return shape.aligned(short, fv.PROFILE_COLUMNS)


@query(
    f"""
    SELECT {SUPPLIER_URL} AS url, CAST(n_lines AS BIGINT) AS guru, CAST(n_a AS BIGINT) AS siswa_laki,
           CAST(n_n AS BIGINT) AS siswa_perempuan, CAST(max_part AS BIGINT) AS rombongan_belajar,
           CAST(quantity AS BIGINT) AS daya_tampung, CAST(n_o AS BIGINT) AS ruang_kelas,
           CAST(n_f AS BIGINT) AS laboratorium,
           CASE WHEN s_acctbal >= 2000 THEN CAST(max_line AS BIGINT) END AS perpustakaan,
           TRY_CAST(n_lines || '.' || n_a % 10 AS DOUBLE) AS rasio_siswa_rombel,
           TRY_CAST(n_o || '.' || n_f % 10 AS DOUBLE) AS rasio_rombel_ruang_kelas,
           CASE WHEN s_acctbal >= 0 THEN CAST(n_lines AS DOUBLE) END AS rasio_siswa_guru,
           CAST(n_a * 100 // n_lines AS DOUBLE) AS persen_guru_kualifikasi,
           CAST(n_n * 100 // n_lines AS DOUBLE) + 0.5 AS persen_guru_sertifikasi,
           CAST(n_o * 100 // n_lines AS DOUBLE) AS persen_guru_pns,
           CAST(n_f * 100 // n_lines AS DOUBLE) AS persen_ruang_kelas_layak
    FROM {SUPPLIERS}
    """
)
def typed_view(spark, sf_dir):
    names = [n for n, _, _ in fv.STATISTIC_KEYWORDS + fv.LEARNING_KEYWORDS]
    return shape.typed_view(_supplier_fields(spark, sf_dir, names))


# files, state and tables ------------------------------------------------------------------------------------------


@query(
    """
    SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, coalesce(role, '-') AS role,
           coalesce(text, '-') AS text
    FROM conversations
    """
)
def csv_round_trip(spark, sf_dir):
    """Text with quotes, commas and newlines written as CSV with a byte order mark and read back."""
    names = ["conv_id", "turn", "role", "text"]
    rows = _text_columns(rd.table(spark, sf_dir, "conversations", *names), names)
    return csv_files.read_published_csv(spark, files.write_csv(rows, new_dir(spark, "csv")), names)


@query("SELECT CAST(conv_id AS VARCHAR) AS conv_id, role, text FROM conversations")
def saved_rows_round_trip(spark, sf_dir):
    """Rows saved as JSON and read back with their schema."""
    names = ["conv_id", "role", "text"]
    rows = _text_columns(rd.table(spark, sf_dir, "conversations", *names), names)
    return state.read_saved_rows(spark, files.write_saved_rows(rows, new_dir(spark, "saved")), names)


@query(
    """
    SELECT CAST(max(event_id) AS INTEGER) AS last_page,
           CAST(sum(CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END) AS BIGINT) AS processed_count,
           549894 AS total_count, max(ts) AS timestamp,
           CAST(count(*) FILTER (event_type <> 'error') AS INTEGER) AS processed_pages,
           CAST(count(*) FILTER (event_type = 'error') AS INTEGER) AS n_failed,
           CAST(sum(event_id) FILTER (event_type = 'error') AS BIGINT) AS failed_sum
    FROM events
    """
)
def state_round_trip(spark, sf_dir):
    """Checkpoint summary written as JSON and read back."""
    status = _event_status(spark, sf_dir).withColumn("attempt", F.lit(1))
    path = new_dir(spark, "checkpoint")
    state.write_checkpoint(status, fv.TOTAL_ROWS, path)
    summary, failed = state.read_checkpoint(spark, path)
    return summary.drop("failed_pages").withColumns(
        {
            "n_failed": failed.agg(F.count(F.lit(1)).cast("int")).scalar(),
            "failed_sum": failed.agg(F.sum("page_num")).scalar(),
        }
    )


@query(
    """
    SELECT CAST(user_id AS INTEGER) AS page_num, CAST(max(event_id) AS INTEGER) AS attempt,
           arg_max(event_type <> 'error', event_id) AS ok,
           CAST(arg_max(CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END, event_id) AS INTEGER) AS n_rows,
           max(ts) AS ts
    FROM events GROUP BY user_id
    """
)
def latest_attempt(spark, sf_dir):
    """Latest outcome per page, with users as pages and their events as attempts."""
    attempts = rd.table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "ts").selectExpr(
        "CAST(user_id AS INT) AS page_num", "CAST(event_id AS INT) AS attempt", *EVENT_STATUS[1:]
    )
    return state.latest_status(attempts)


@query(
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS npsn, c_name AS nama_sekolah, {PLACE} AS alamat_sekolah,
           coalesce({STATUS}, '-') AS status_sekolah
    FROM {PEOPLE}
    """
)
def published_table(spark, sf_dir):
    """Cards published under a table name and read by that name."""
    rows = cd.published_cards(_customer_cards(spark, sf_dir))
    return spark.table(table.publish_table(rows, "published_cards", new_dir(spark, "table")))


# whole runs -------------------------------------------------------------------------------------------------------


@query(
    f"""
    SELECT npsn, nama_sekolah, alamat_sekolah, coalesce(status_sekolah, '-') AS status_sekolah
    FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE filled
    QUALIFY row_number() OVER (PARTITION BY npsn ORDER BY cards.page_num, pos) = 1
    """
)
def list_run(spark, sf_dir):
    """First pass, retry of what failed, keep-first dedup and the published CSV, read back."""
    fetched = stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    config = RunConfig("list", new_dir(spark, "run"), rd.SITE, total_rows=total)
    result = runs.run_list(spark, fetched, config, retries=[fetched.withColumn("success", F.lit(True))])
    return csv_files.read_published_csv(spark, result.path, fv.CARD_COLUMNS)


@query(
    f"""
    SELECT {", ".join(f"coalesce({c}, '-') AS {c}" for c in fv.PROFILE_COLUMNS)}
    FROM (
        SELECT coalesce({NPSN_SQL}, CAST(c_custkey AS VARCHAR)) AS npsn, {PROFILE_URL} AS url,
               c_name AS nama_sekolah, n_name || ', ' || r_name AS alamat_sekolah, {PLACE} AS alamat_jalan,
               {DOCUMENT_SQL}, {LABELS_AS_DETAIL}, coalesce(detail_status, {STATUS}) AS status_sekolah, {CONTACTS_SQL},
               {UTILITIES_SQL.format(beyond=chr(39) + 'beyond' + chr(39))}, {NO_STATISTICS}, {COORDINATES_SQL}
        FROM {PEOPLE})
    """
)
def profile_run(spark, sf_dir):
    """One list page entry and one profile page per customer to the published wide table."""
    links = rd.customers(spark, sf_dir).selectExpr("CAST(c_custkey AS STRING) AS npsn", f"{rd.PROFILE_URL} AS url")
    cards = _customer_cards(spark, sf_dir).withColumnRenamed("alamat_sekolah", "alamat_jalan").join(links, "npsn")
    config = RunConfig("profile", new_dir(spark, "run"), rd.SITE)
    return runs.run_profiles(spark, cards, rd.profile_pages(spark, sf_dir), config)


def _list_config(spark, sf_dir, name, **settings):
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    return RunConfig(name, new_dir(spark, "run"), rd.SITE, total_rows=total, **settings)


@query(
    f"""
    WITH numbered AS (
        SELECT cards.*, row_number() OVER (ORDER BY NOT success, cards.page_num, pos) AS row_num
        FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE filled
    ), size AS (SELECT count(*) AS n FROM numbered),
    whole AS (SELECT bool_and(filled) AS w FROM ({CRAWL}))
    SELECT {LABEL.format(s=100, high='least((row_num - 1) // 100 * 100 + 100, n)')} AS batch, npsn, nama_sekolah,
           alamat_sekolah, coalesce(status_sekolah, '-') AS status_sekolah
    FROM numbered, size, whole WHERE w OR row_num <= n // 100 * 100
    """
)
def list_run_batches(spark, sf_dir):
    """Batch files of a run in three commits a pass that was cut in its middle, went on, and tried failures again."""
    fetched = stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    config = _list_config(spark, sf_dir, "batches", batch_files=True)
    pages_planned = page_plan.page_bounds(config)[1]
    config = replace(config, pages_per_commit=-(-pages_planned // 3))
    runs.run_pass(spark, fetched, replace(config, last_page=2 * config.pages_per_commit - 1))
    runs.run_list(spark, fetched, config, retries=[fetched.withColumn("success", F.lit(True))])
    path = f"{config.work_dir}/{config.run_id}/batches"
    return csv_files.read_published_csv(spark, path, [*fv.CARD_COLUMNS, "batch", "commit"]).drop("commit")


@query(
    f"""
    WITH first AS (
        SELECT npsn, cards.page_num, pos FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num
        WHERE success AND filled QUALIFY row_number() OVER (PARTITION BY npsn ORDER BY cards.page_num, pos) = 1
    )
    SELECT npsn, row_number() OVER (ORDER BY page_num, pos) AS row_num FROM first
    """
)
def list_run_order(spark, sf_dir):
    """The published rows with the place that the order of files and of lines in them gives."""
    fetched = stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    config = _list_config(spark, sf_dir, "order")
    runs.run_list(spark, fetched, config)
    rows = csv_files.read_in_published_order(spark, runs.published_path(spark, config), fv.CARD_COLUMNS)
    placed = numbering.numbered(stored(rows.select(F.col("file").alias("page_num"), F.col("line").alias("pos"), "npsn"), "published"))
    return placed.select("npsn", "row_num")


@query(
    f"""
    WITH crawl AS ({CRAWL}),
         stop AS (SELECT coalesce(min(page_num) FILTER (success AND NOT filled), 2147483647) AS once,
                         coalesce(min(page_num) FILTER (NOT filled), 2147483647) AS retried FROM crawl)
    SELECT 'all' AS run_id, CASE WHEN bool_and(filled) THEN 'complete' ELSE 'partial' END AS state FROM crawl
    UNION ALL SELECT 'stops', CASE WHEN coalesce(bool_and(success) FILTER (page_num < once), true) THEN 'complete' ELSE 'partial' END FROM crawl, stop
    UNION ALL SELECT 'stops-retried', CASE WHEN coalesce(bool_and(filled) FILTER (page_num < retried), true) THEN 'complete' ELSE 'partial' END
    FROM crawl, stop
    """
)
def run_states(spark, sf_dir):
    """What three runs over one crawl say of themselves: all pages wanted, or those before the first empty one."""
    fetched = stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    again = fetched.withColumn("success", F.lit(True))
    states = []
    for name, stops, retries in (("all", False, [again]), ("stops", True, []), ("stops-retried", True, [again])):
        config = _list_config(spark, sf_dir, name, stop_at_empty_page=stops)
        runs.run_list(spark, fetched, config, retries)
        states.append(spark.read.schema(runs.RUNS).parquet(config.work_dir + "/runs").select("run_id", "state"))
    return states[0].unionByName(states[1]).unionByName(states[2])


def _profile_run_in_two(spark, sf_dir):
    """A run over profile pages of which some could not be read or were not there at first, and were later."""
    links = rd.customers(spark, sf_dir).selectExpr("CAST(c_custkey AS STRING) AS npsn", f"{rd.PROFILE_URL} AS url", "c_custkey")
    cards = _customer_cards(spark, sf_dir).withColumnRenamed("alamat_sekolah", "alamat_jalan").join(links.drop("c_custkey"), "npsn")
    cards, saved = stored(cards, "cards"), rd.profile_pages(spark, sf_dir)
    kept = saved.join(links.withColumn("part", F.expr("c_custkey % 5")).drop("npsn"), "url")
    first = kept.where("part <> 3").withColumn("html", F.when(F.col("part") != 1, F.col("html"))).select("url", "html")
    config = RunConfig("profiles", new_dir(spark, "run"), rd.SITE, profile_ranges=2)
    runs.run_profiles(spark, cards, stored(first, "first"), config)
    return cards, stored(saved, "saved"), config


@query(ORACLES["profile_run"])
def profile_run_resumed(spark, sf_dir):
    """The wide table of a run that first found two fifths of its profiles missing or unreadable, and was called again."""
    cards, saved, config = _profile_run_in_two(spark, sf_dir)
    return runs.run_profiles(spark, cards, saved, config)


@query(
    f"""
    SELECT {PROFILE_URL} AS url, CASE WHEN c_custkey % 5 = 1 THEN 'no html' ELSE 'no snapshot' END AS reason
    FROM {PEOPLE} WHERE c_custkey % 5 IN (1, 3)
    """
)
def profile_rejects(spark, sf_dir):
    """Listed profiles without a row, and why."""
    _, _, config = _profile_run_in_two(spark, sf_dir)
    return spark.read.parquet(runs.published_path(spark, config) + "/rejects")


@query(ORACLES["profile_run"].replace(f"FROM {PEOPLE})", f"FROM {PEOPLE} WHERE {PROFILE_URL} LIKE '%profil-sekolah%')"))
def directory_run(spark, sf_dir):
    """List pages, the profiles that their cards led to, and the merge of both, in one run."""
    lists = rd.customer_pages(spark, sf_dir).withColumn("success", F.lit(True)).withColumn("fetched_at", F.lit(None).cast("timestamp"))
    people = rd.customers(spark, sf_dir)
    opened = people.selectExpr(
        f"CAST(c_custkey div {rd.PAGE_SIZE} AS INT) AS page_num",
        f"'{BASE}/sekolah' AS list_url",
        f"{rd.PROFILE_URL} AS observed_url",
        "c_custkey",
    )
    in_page = Window.partitionBy("page_num").orderBy("c_custkey")
    opened = opened.withColumn("pos", (F.row_number().over(in_page) - 1).cast("int")).drop("c_custkey")
    profiles = rd.profile_pages(spark, sf_dir)
    last = people.agg(F.max("c_custkey")).first()[0]
    config = RunConfig("directory", new_dir(spark, "run"), rd.SITE, total_rows=(last // rd.PAGE_SIZE + 1) * fv.PAGE_SIZE)
    return runs.run_directory(spark, stored(lists, "lists"), opened, stored(profiles, "profiles"), config)


# streams ----------------------------------------------------------------------------------------------------------


def _arrivals(spark, sf_dir):
    """Crawled pages as a folder of files that a stream picks up sixteen at a time."""
    path = new_dir(spark, "arrivals")
    rd.crawled_pages(spark, sf_dir).select(*ingest.SNAPSHOT.names).repartition(32, "page_num").write.parquet(path)
    return ingest.page_stream(spark, path, max_files=16)


@query(
    f"""
    SELECT DISTINCT npsn, nama_sekolah, alamat_sekolah, status_sekolah
    FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE success AND filled
    """
)
def stream_distinct(spark, sf_dir):
    """First arrival of every identifier over a stream of page files."""
    out = new_dir(spark, "distinct")
    ingest.ingest_distinct(_arrivals(spark, sf_dir), out, new_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select(*fv.CARD_COLUMNS)


@query(
    f"""
    SELECT page_num, success AND filled AS ok, CAST(CASE WHEN success AND filled THEN n ELSE 0 END AS INTEGER) AS n_rows
    FROM ({CRAWL})
    """
)
def stream_ingest(spark, sf_dir):
    """Outcome of every page of a stream, failed pages included."""
    out = new_dir(spark, "results")
    ingest.ingest(_arrivals(spark, sf_dir), out, new_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("page_num", "ok", "n_rows")


@query(
    f"""
    SELECT cards.page_num, pos, npsn FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE filled
    """
)
def stream_then_pass(spark, sf_dir):
    """Pages that came by a stream, failures that a pass read, and a third of all pages streamed again: each counts once."""
    config = _list_config(spark, sf_dir, "mixed")
    out, checkpoint = f"{config.work_dir}/{config.run_id}/page_results", new_dir(spark, "checkpoint")
    arrivals, crawled = new_dir(spark, "arrivals"), stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    again = crawled.withColumn("success", F.lit(True))
    crawled.select(*ingest.SNAPSHOT.names).repartition(8, "page_num").write.parquet(arrivals)
    ingest.ingest(ingest.page_stream(spark, arrivals, max_files=5), out, checkpoint).awaitTermination()
    runs.run_pass(spark, again, config)
    again.where("page_num % 3 = 1").select(*ingest.SNAPSHOT.names).repartition(2, "page_num").write.mode("append").parquet(arrivals)
    ingest.ingest(ingest.page_stream(spark, arrivals, max_files=5), out, checkpoint).awaitTermination()
    return runs.collected_rows(spark, config).select("page_num", "pos", "npsn")


@query(
    f"""
    SELECT npsn, cards.page_num, pos FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num
    WHERE success AND filled QUALIFY row_number() OVER (PARTITION BY npsn ORDER BY cards.page_num % 2 = 0, cards.page_num, pos) = 1
    """
)
def stream_first_arrival(spark, sf_dir):
    """Where the first arrival of every identifier stood: odd pages come first, even ones later."""
    arrivals, out, checkpoint = new_dir(spark, "arrivals"), new_dir(spark, "distinct"), new_dir(spark, "checkpoint")
    crawled = stored(rd.crawled_pages(spark, sf_dir).select(*ingest.SNAPSHOT.names), "snapshots")
    for rest in (1, 0):
        crawled.where(F.col("page_num") % 2 == rest).repartition(8, "page_num").write.mode("append").parquet(arrivals)
        ingest.ingest_distinct(ingest.page_stream(spark, arrivals), out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("npsn", "page_num", "pos")


@query(
    f"""
    WITH crawl AS ({CRAWL}), planned AS (SELECT CAST(ceil(count(*) / 48.0) AS BIGINT) AS n FROM orders)
    SELECT CAST(2 AS BIGINT) AS batches, count(*) AS total_pages, count(*) FILTER (success AND filled) AS total_pages_ok,
           CAST(sum(CASE WHEN success AND filled THEN crawl.n ELSE 0 END) AS BIGINT) AS total_rows,
           count(*) FILTER (success AND filled) * 100.0::DOUBLE / any_value(planned.n) AS percent
    FROM crawl, planned
    """
)
def stream_progress(spark, sf_dir):
    """What the progress of a stream says after its last micro-batch."""
    out = new_dir(spark, "results")
    planned = page_plan.page_count(spark.read.parquet(f"{sf_dir}/orders.parquet").count())
    ingest.ingest(_arrivals(spark, sf_dir), out, new_dir(spark, "checkpoint"), planned).awaitTermination()
    rows = ingest.live_progress(spark, out)
    totals = ("total_pages", "total_pages_ok", "total_rows", "percent")
    return rows.agg(F.count("*").alias("batches"), *(F.max_by(c, "attempt").alias(c) for c in totals))


@query(
    f"""
    SELECT npsn, replace(nama_sekolah, 'Customer', 'Cüstömer') AS nama_sekolah, alamat_sekolah, coalesce(status_sekolah, '-') AS status_sekolah
    FROM ({ORDER_CARDS}) QUALIFY row_number() OVER (PARTITION BY npsn ORDER BY page_num, pos) = 1
    """
)
def html_files_run(spark, sf_dir):
    """A run over saved files, half of them in UTF-8 and half in windows-1252 as their meta element says."""
    html = F.regexp_replace(F.replace("html", F.lit("Customer"), F.lit("Cüstömer")), r"\s+", " ")
    saved = stored(rd.order_pages(spark, sf_dir).select(F.col("page_num").alias("page"), html.alias("html")), "saved")
    folder = new_dir(spark, "html")
    files.write_pages(saved.where("page % 2 = 0"), folder + "/utf8")
    meta = F.concat(F.lit('<meta http-equiv="content-type" content="text/html; charset=ISO-8859-1">'), "html").alias("html")
    files.write_pages(saved.where("page % 2 = 1").select("page", meta), folder + "/latin", "ISO-8859-1")
    files_read = snapshots.read_html_files(spark, folder, "part-*")
    pages_read = snapshots.list_snapshots(files_read, r"page=(\d+)/")
    result = runs.run_list(spark, pages_read, _list_config(spark, sf_dir, "files"))
    return csv_files.read_published_csv(spark, result.path, fv.CARD_COLUMNS)


@query(
    f"""
    SELECT npsn, nama_sekolah, alamat_sekolah, status_sekolah
    FROM ({ORDER_CARDS}) AS cards JOIN ({CRAWL}) AS crawl ON cards.page_num = crawl.page_num WHERE success AND filled
    """
)
def resume_from_summary(spark, sf_dir):
    """A run that goes on from another program's checkpoint: summary with failed pages, and saved rows."""
    fetched = stored(rd.crawled_pages(spark, sf_dir), "snapshots")
    config = _list_config(spark, sf_dir, "seeded")
    last = page_plan.page_bounds(config)[1] // 2
    before = stored(runs.page_results(fetched.where(F.col("page_num") <= last)), "before")
    folder = new_dir(spark, "checkpoint")
    failed = F.collect_list(F.when(~F.col("ok"), F.col("page_num"))).alias("failed_pages")
    summary = before.agg(F.max("page_num").alias("last_page"), F.sum("n_rows").alias("processed_count"), failed)
    summary.coalesce(1).write.json(folder + "/summary")
    files.write_saved_rows(cd.card_rows(before.where("ok"), "page_num").select(*fv.CARD_COLUMNS), folder + "/rows")
    saved = state.read_saved_rows(spark, folder + "/rows", fv.CARD_COLUMNS)
    runs.resume_from_summary(spark, config, state.read_summary(spark, folder + "/summary"), saved)
    return runs.run_list(spark, fetched, config).rows.select(*fv.CARD_COLUMNS)
