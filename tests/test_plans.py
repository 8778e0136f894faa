"""What Spark makes of the queries: scans, shuffles and joins."""

import re

import pytest

from pagesift.operators import numbering, shape, skew
from pagesift.plans.queries import QUERIES
from pagesift.session import stored


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# these hand back what they wrote, so their plan is a scan
WRITTEN = {
    "list_run", "profile_run", "stream_distinct", "stream_ingest", "batch_files", "batch_files_packed", "list_run_batches", "list_run_order", "run_states",
    "profile_run_resumed", "profile_rejects", "directory_run", "stream_then_pass", "stream_first_arrival",
    "stream_progress", "html_files_run", "resume_from_summary",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITTEN))
def test_no_pairwise_joins(spark, testdata, name):
    plan = plan_of(QUERIES[name](spark, f"{testdata}/sf0.001"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_is_used(spark, testdata):
    plan = plan_of(QUERIES["page_title"](spark, f"{testdata}/sf0.001"))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["page_id:bigint,html:string"]


def test_extraction_of_given_pages_parses_once_and_html_stops_there(spark, testdata):
    plan = plan_of(QUERIES["page_title"](spark, f"{testdata}/sf0.001"))
    assert plan.count("MapInArrow") == 1
    assert "html" not in plan.split("MapInArrow")[0]


def test_cards_are_extracted_once(spark, testdata):
    plan = plan_of(QUERIES["card_dedup_first"](spark, f"{testdata}/sf0.001"))
    extraction = plan.split("MapInArrow")[0]
    assert extraction.count("text-orange-600") == 1
    assert plan.count("MapInArrow") == 1


def test_dedup_shrinks_before_its_shuffle(spark):
    rows = stored(spark.range(100).selectExpr("'hot' AS npsn", "CAST(id AS INT) AS page_num", "0 AS pos"), "rows")
    plan = plan_of(shape.keep_first(rows))
    assert plan.count("Exchange") == 1 and "partial_min" in plan[plan.index("Exchange"):]


def test_numbering_has_no_global_sort_and_shuffles_rows_once(spark):
    rows = stored(
        spark.range(100).selectExpr("CAST(id AS INT) AS page_num", "0 AS pos", "'x' AS npsn"), "rows"
    )
    plan = plan_of(numbering.numbered(rows))
    assert "rangepartitioning" not in plan
    single = [line for line in plan.split("\n") if "Exchange SinglePartition" in line]
    assert len(single) == 1  # the at most 32,768 blocks
    assert plan.count("npsn#") and len(re.findall(r"ReadSchema: struct<[^>]*npsn", plan)) == 1


def test_hot_keys_are_the_only_broadcast_of_the_spread_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = stored(spark.range(1000).selectExpr("CAST(id AS STRING) AS url", "CAST(id AS INT) AS pos"), "rows")
        lookup = stored(spark.range(1000).selectExpr("CAST(id AS STRING) AS url", "'x' AS v"), "lookup")
        plan = plan_of(skew.spread_join(rows, lookup, "url"))
        assert "SortMergeJoin [url" in plan and "_salt" in plan
        for line in plan.split("\n"):
            if "BroadcastHashJoin" in line:
                assert "LeftOuter, BuildRight" in line  # against the hot keys
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_retry_moves_no_html(spark):
    """Neither for scattered failures nor for a run that was cut."""
    from pagesift.operators import pages

    snapshots = stored(spark.range(200_000).selectExpr("CAST(id AS INT) AS page_num", "'x' AS html"), "snapshots")
    scattered = stored(spark.range(200_000).selectExpr("CAST(id AS INT) AS page_num", "id % 97 <> 5 AS ok"), "status")
    for status, left in ((scattered, {n for n in range(200_000) if n % 97 == 5}), (scattered.where("page_num < 70000"), {n for n in range(200_000) if n >= 70_000 or n % 97 == 5})):
        found = pages.without_done(snapshots, status)
        plan = plan_of(found)
        assert "SortMergeJoin" not in plan and "html" not in "".join(x for x in plan.split("Exchange")[1:] if "html" in x.split("\n")[0])
        assert {r.page_num for r in found.select("page_num").collect()} == left


def test_numbering_in_the_page_row_moves_no_card(spark):
    pages = spark.range(50).selectExpr("CAST(id AS INT) AS page_num", "CAST(id % 3 AS INT) AS n_rows", "transform(sequence(1, id % 3), i -> named_struct('pos', CAST(i * 2 AS INT), 'card', named_struct('npsn', concat(id, '-', i)))) AS cards")
    pages = pages.selectExpr("page_num", "n_rows", "slice(cards, 1, n_rows) AS cards")
    rows = numbering.batched_pages(stored(pages, "pages"), 7)
    plan = plan_of(rows)
    assert "Sort [pos" not in plan
    for part in plan.split("Exchange")[1:]:
        assert "cards" not in part.split("\n")[0]
    assert "SortMergeJoin" not in plan
    got = [(r.page_num, r.pos, r.row_num, r.batch_label) for r in rows.orderBy("row_num").collect()]
    places = [(p, 2 * (i + 1)) for p in range(50) for i in range(p % 3)]
    assert got == [(p, pos, k + 1, f"batch_{k // 7 * 7 + 1}-{min(k // 7 * 7 + 7, len(places))}") for k, (p, pos) in enumerate(places)]
