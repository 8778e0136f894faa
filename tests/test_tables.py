"""Outcomes, numbering, dedup, metrics and joins: small cases and properties."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.config import RunConfig, SiteConfig
from pagesift.operators import merge, metrics, numbering, pages, shape, skew
from pagesift.session import stored
from pagesift.sources import page_plan, state


def config(**settings):
    return RunConfig("r", "unused", **settings)


def plan_numbers(spark, **settings):
    return [r.page_num for r in page_plan.page_plan(spark, config(**settings)).orderBy("page_num").collect()]


def test_page_count():
    assert page_plan.page_count() == 11_457
    assert [page_plan.page_count(n, 48) for n in (0, 1, 48, 49)] == [0, 1, 1, 2]


def test_plan_limits(spark):
    assert plan_numbers(spark, total_rows=100) == [0, 1, 2]
    assert plan_numbers(spark, total_rows=480, start_page=3, max_pages=2) == [3, 4]
    assert plan_numbers(spark, total_rows=480, start_page=3, last_page=4) == [3, 4]
    assert plan_numbers(spark, total_rows=100, start_page=9) == []


def test_plan_url_and_its_inverse(spark):
    url = page_plan.page_plan(spark, config(site=SiteConfig("d.id"), total_rows=1)).first().url
    assert url == "https://sekolah.data.d.id/sekolah?page=0&size=48"
    urls = spark.createDataFrame([(url,), ("http://x/?a=1",), ("http://x/?page=z",), (None,)], "u STRING")
    assert [r.p for r in urls.select(page_plan.page_number(F.col("u")).alias("p")).collect()] == [0, None, None, None]


def status(spark, rows):
    return spark.createDataFrame(rows, "page_num INT, ok BOOLEAN")


def test_pending_and_done_split_the_plan(spark):
    plan = spark.range(200_000).select(F.col("id").cast("int").alias("page_num"))
    # block 0 complete, block 1 partly, block 2 untouched
    done = plan.select("page_num", ((F.col("page_num") < 65_536) | (F.col("page_num") % 3 == 0) & (F.col("page_num") < 131_072)).alias("ok"))
    pending = pages.pending_pages(plan, done)
    expected = done.where("NOT ok").count()
    assert pending.count() == expected
    left = pages.without_done(plan.withColumn("html", F.lit("x")), done)
    assert left.count() == expected and left.columns == ["page_num", "html"]
    assert left.join(done.where("ok"), "page_num").count() == 0


def test_stop_only_at_a_page_that_was_read_and_empty(spark):
    results = spark.createDataFrame(
        [(0, True, 3), (1, False, 0), (2, True, 1), (3, True, 0), (4, True, 9), (5, True, 0)],
        "page_num INT, success BOOLEAN, n_rows INT",
    )
    assert sorted(r.page_num for r in pages.until_empty_page(results).collect()) == [0, 1, 2]
    assert pages.until_empty_page(results.where("n_rows > 0")).count() == 3


def test_retry_counts(spark):
    failed = status(spark, [(1, False), (2, False), (3, False)])
    again = status(spark, [(1, True), (2, False)])
    assert sorted(r.page_num for r in pages.still_failed(failed, again).collect()) == [2, 3]
    assert metrics.retry_yield(failed, again).first() == (3, 1, 2)


def rows_of(spark, places, extra=""):
    return spark.createDataFrame([(p, q, f"k{p}-{q}") for p, q in places], "page_num INT, pos INT, npsn STRING")


def test_row_numbers_with_gaps_hot_pages_and_far_blocks(spark):
    random.seed(5)
    places = {(7, q) for q in range(0, 3000, 2)}  # a page with half of all rows, with gaps
    places |= {(7, 65_536 * k + 5) for k in range(4)}  # positions in other chunks of the same page
    places |= {(random.randrange(2**31 - 1), random.randrange(100)) for _ in range(1500)}
    rows = stored(rows_of(spark, places), "rows")
    numbered = numbering.numbered(rows).collect()
    expected = {place: i + 1 for i, place in enumerate(sorted(places))}
    assert {(r.page_num, r.pos): r.row_num for r in numbered} == expected


@pytest.mark.parametrize("n, size", [(0, 10), (1, 10), (10, 10), (25, 10)])
def test_every_row_is_in_one_batch(spark, n, size):
    rows = stored(rows_of(spark, [(i // 4, i % 4) for i in range(n)]), "rows")
    batches = numbering.batched(rows, size).collect()
    assert sorted(r.row_num for r in batches) == list(range(1, n + 1))
    assert Counter(r.batch_id for r in batches) == Counter(i // size for i in range(n))
    for r in batches:
        low = r.batch_id * size + 1
        assert r.batch_label == f"batch_{low}-{min(low + size - 1, n)}"


def test_manifest_labels_without_clipping(spark):
    rows = stored(rows_of(spark, [(0, i) for i in range(7)]), "rows")
    found = numbering.batch_manifest(numbering.batched(rows, 5, clip=False)).orderBy("batch_id").collect()
    assert found == [(0, "batch_1-5", 5, 1, 5), (1, "batch_6-10", 2, 6, 7)]


def test_keep_first_is_idempotent_and_ignores_partitioning(spark):
    random.seed(1)
    data = [(p, q, random.choice(["hot", f"k{random.randrange(50)}"])) for p in range(60) for q in range(5)]
    random.shuffle(data)
    rows = spark.createDataFrame(data, "page_num INT, pos INT, npsn STRING")
    first = {}
    for p, q, key in sorted(data):
        first.setdefault(key, (p, q))
    for parts in (1, 7):
        once = shape.keep_first(rows.repartition(parts))
        assert {r.npsn: (r.page_num, r.pos) for r in once.collect()} == first
        assert once.columns == rows.columns
    assert sorted(shape.keep_first(once).collect()) == sorted(once.collect())


def test_hot_keys_are_few_and_join_is_whole(spark):
    data = [("hot", i) for i in range(3000)] + [(f"k{i % 400}", i) for i in range(3000)] + [(None, 1)]
    rows = stored(spark.createDataFrame(data, "url STRING, pos INT"), "rows")
    lookup = spark.createDataFrame([("hot", "h")] + [(f"k{i}", "x") for i in range(0, 400, 2)], "url STRING, v STRING")
    hot = {r.url for r in skew.hot_keys(rows, "url", 100).collect()}
    assert hot == {"hot"}
    joined = skew.spread_join(rows, lookup, "url", salts=5)
    assert joined.count() == rows.join(lookup, "url").count() == 4500
    assert joined.columns == ["url", "pos", "v"]


def test_hot_rows_are_spread_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = stored(spark.range(4000).selectExpr("'hot' AS url", "CAST(id AS INT) AS pos"), "rows")
        lookup = spark.createDataFrame([("hot", "h")], "url STRING, v STRING")
        shares = skew.spread_join(rows, lookup, "url").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in shares) == 4000
        assert max(r["count"] for r in shares) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


CARDS = "page_num INT, pos INT, npsn STRING, url STRING, nama_sekolah STRING, status_sekolah STRING, alamat_jalan STRING"


def detail(spark, **values):
    schema = ", ".join(f"{c} STRING" for c in fv.PROFILE_COLUMNS)
    return spark.createDataFrame([tuple(values.get(c) for c in fv.PROFILE_COLUMNS)], schema)


def test_merge_precedence(spark):
    cards = spark.createDataFrame(
        [(0, 0, "1", "u", "list", None, "street"), (0, 1, "2", "u", None, "L", None), (0, 2, "3", None, "n", "s", "a"),
         (0, 3, "4", "", "n", "s", "a"), (0, 4, "5", "other", "n", "s", "a")],
        CARDS,
    )
    one = detail(spark, url="u", npsn="P9", nama_sekolah="", status_sekolah="D", alamat_sekolah="A", guru="7")

    def pick(df):
        names = ["npsn", "nama_sekolah", "status_sekolah", "alamat_jalan", "alamat_sekolah", "guru"]
        return [tuple(r) for r in df.orderBy("pos").select(names).collect()]

    assert pick(merge.merge_detail_first(cards, one, "pos")) == [
        ("P9", "", "D", "street", "A", "7"), ("P9", "", "D", None, "A", "7"),
    ]
    assert pick(merge.merge_list_first(cards, one, "pos")) == [
        ("1", "list", "D", "street", "A", "7"), ("2", "", "L", "A", "A", "7"),
    ]
    assert merge.merge_detail_first(cards, one).columns == fv.PROFILE_COLUMNS


def test_run_totals(spark):
    status_rows = spark.createDataFrame(
        [(0, True, 5, datetime(2024, 1, 1)), (1, False, 0, None), (2, True, 7, datetime(2024, 1, 1, 0, 0, 4))],
        "page_num INT, ok BOOLEAN, n_rows INT, ts TIMESTAMP",
    )
    found = metrics.run_totals(status_rows).first().asDict()
    assert (found["total_rows"], found["pages_planned"], found["pages_ok"], found["pages_failed"]) == (12, 3, 2, 1)
    assert found["rows_per_second"] == 3.0 and found["progress_percent"] == pytest.approx(200 / 3)
    none = metrics.run_totals(status_rows.where("false")).first().asDict()
    assert (none["total_rows"], none["rows_per_second"], none["progress_percent"]) == (0, 0.0, 0.0)


def test_widths_and_completeness(spark):
    rows = spark.createDataFrame([("x" * 200, None), ("y", "-")], "npsn STRING, nama_sekolah STRING")
    assert sorted(metrics.column_widths(rows).collect()) == [("nama_sekolah", 14), ("npsn", 100)]
    assert sorted(metrics.completeness(rows).collect()) == [("nama_sekolah", 2, 2, 1.0), ("npsn", 2, 0, 0.0)]
    assert sorted(metrics.column_widths(rows.where("false")).collect()) == [("nama_sekolah", 14), ("npsn", 6)]


def test_union_and_alignment(spark):
    a = spark.createDataFrame([("1", "x")], "npsn STRING, b STRING")
    b = spark.createDataFrame([("2", None)], "npsn STRING, a STRING")
    union = shape.union_of_keys([a, b])
    assert union.columns == ["a", "b", "npsn"]
    assert sorted(union.collect()) == [("-", "-", "2"), ("-", "x", "1")]
    assert shape.aligned(a, ["c", "npsn"]).collect() == [("-", "1")]


def test_typed_view(spark):
    rows = spark.createDataFrame(
        [("1.234", "1.234,5", "12,5 %", "-6.2"), ("-", "-", "", "x"), (" 7 ", "20:1", "100%", None)],
        "guru STRING, rasio_siswa_guru STRING, persen_guru_pns STRING, lintang STRING",
    )
    assert shape.typed_view(rows).collect() == [(1234, 1234.5, 12.5, -6.2), (None, None, None, None), (7, 20.0, 100.0, None)]


def test_latest_status(spark):
    rows = spark.createDataFrame(
        [(1, 1, True, 3, None), (1, 2, False, 0, None), (2, 1, False, 0, None), (2, 1, True, 4, None)],
        state.PAGE_STATUS,
    )
    found = {r.page_num: (r.attempt, r.ok, r.n_rows) for r in state.latest_status(rows).collect()}
    assert found == {1: (2, False, 0), 2: (1, True, 4)}
