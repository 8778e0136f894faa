"""Files, state, tables, whole runs and streams."""

import json
from datetime import datetime

import pytest

from pagesift import fixed_values as fv
from pagesift.config import RunConfig
from pagesift.operators import numbering
from pagesift.plans import run as runs
from pagesift.session import new_dir, shared_dir, stored
from pagesift.sinks import files, table
from pagesift.sources import csv_files, snapshots, state
from pagesift.streaming import ingest

SNAPSHOT = "page_num INT, html STRING, success BOOLEAN, fetched_at TIMESTAMP"
AT = datetime(2024, 5, 6, 7, 8, 9)


def page(*ids):
    return "".join(f"<article>NPSN : {i}<h3>N{i}</h3></article>" for i in ids)


def crawl(spark, *rows):
    return spark.createDataFrame([(n, html, ok, AT) for n, html, ok in rows], SNAPSHOT)


def local(path):
    import pathlib

    return pathlib.Path(path.removeprefix("file:"))


# files ------------------------------------------------------------------------------------------------


def test_csv_bytes(spark):
    rows = spark.createDataFrame(
        [("1", 'a "b", c', None, " x "), ("2", "l1\nl2", "", "é—")], ", ".join(f"{c} STRING" for c in fv.CARD_COLUMNS)
    )
    path = files.write_csv(rows.coalesce(1), new_dir(spark, "csv"))
    (part,) = local(path).glob("part-*.csv")
    text = part.read_bytes()
    assert text.startswith("﻿npsn,nama_sekolah,alamat_sekolah,status_sekolah\n".encode())
    assert text.decode("utf-8-sig").split("\n", 1)[1] == '1,"a ""b"", c",-, x \n2,"l1\nl2",,é—\n'
    back = csv_files.read_published_csv(spark, path, fv.CARD_COLUMNS).orderBy("npsn").collect()
    assert back == [("1", 'a "b", c', "-", " x "), ("2", "l1\nl2", None, "é—")]


def test_every_part_has_header_and_mark(spark):
    rows = spark.range(10).selectExpr("CAST(id AS STRING) AS npsn", "'x' AS v").repartition(3)
    path = files.write_csv(rows, new_dir(spark, "csv"))
    parts = list(local(path).glob("part-*.csv"))
    assert len(parts) == 3 and all(p.read_bytes().startswith(b"\xef\xbb\xbfnpsn,v\n") for p in parts)
    assert csv_files.read_published_csv(spark, path, ["npsn", "v"]).count() == 10


def test_batch_folders(spark):
    rows = stored(
        spark.range(23).selectExpr("CAST(id div 5 AS INT) AS page_num", "CAST(id % 5 AS INT) AS pos", "CAST(id AS STRING) AS npsn"),
        "rows",
    )
    path = files.write_batches(numbering.batched(rows, 10), new_dir(spark, "batches"))
    names = sorted(p.name for p in local(path).glob("batch=*"))
    assert names == ["batch=batch_1-10", "batch=batch_11-20", "batch=batch_21-23"]
    for name in names:
        (part,) = (local(path) / name).glob("part-*.csv")
        lines = part.read_text("utf-8-sig").split()
        assert lines[0] == "npsn" and [int(x) for x in lines[1:]] == sorted(int(x) for x in lines[1:])


def test_wide_table_keeps_its_widths(spark):
    rows = spark.createDataFrame([("1", "abc")], "npsn STRING, nama_sekolah STRING")
    path = files.write_wide_table(rows, new_dir(spark, "wide"))
    assert spark.read.parquet(path + "/rows").collect() == [("1", "abc")]
    assert sorted(spark.read.parquet(path + "/widths").collect()) == [("nama_sekolah", 14), ("npsn", 6)]


def test_stamped_name(spark):
    assert files.stamped_name(AT) == AT.strftime("data_sekolah_%Y%m%d_%H%M%S")
    from pyspark.sql import functions as F

    assert spark.range(1).select(files.stamp(F.lit(AT)).alias("s")).first().s == AT.strftime("data_sekolah_%Y%m%d_%H%M%S")


def test_html_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.html").write_text("<h1>é</h1>", encoding="utf-8")
    (tmp_path / "sub" / "b.html").write_text("<h1>b</h1>", encoding="utf-8")
    (tmp_path / "c.txt").write_text("no")
    found = snapshots.read_html_files(spark, str(tmp_path)).orderBy("url").collect()
    assert [(r.url.rsplit("/", 1)[1], r.html) for r in found] == [("a.html", "<h1>é</h1>"), ("b.html", "<h1>b</h1>")]


# state ------------------------------------------------------------------------------------------------


def test_summary_files(spark, tmp_path):
    short = {"last_page": 7, "processed_count": 311, "total_count": 0, "timestamp": "2024-05-06T07:08:09.101112"}
    long = short | {"processed_pages": 4, "failed_pages": [2, 3], "timestamp": "2024-05-06T07:08:09"}
    for name, text in [("short", json.dumps(short, indent=2)), ("long", json.dumps(long, indent=2)), ("bad", '{"last_page": 5, "proc')]:
        (tmp_path / f"{name}.json").write_text(text)

    def read(name):
        return state.read_summary(spark, str(tmp_path / f"{name}.json")).collect()

    assert read("short") == [(7, 311, 0, datetime(2024, 5, 6, 7, 8, 9, 101112), None, None)]
    assert read("long") == [(7, 311, 0, datetime(2024, 5, 6, 7, 8, 9), 4, [2, 3])]
    assert read("bad") == [] and read("missing") == []
    listed = state.listed_failures(state.read_summary(spark, str(tmp_path / "long.json")))
    assert [r.page_num for r in listed.collect()] == [2, 3]


def test_checkpoint_export(spark):
    status = spark.createDataFrame(
        [(0, 1, True, 5, AT), (1, 1, False, 0, AT), (1, 2, True, 4, AT), (2, 1, False, 0, None)], state.PAGE_STATUS
    )
    path = new_dir(spark, "checkpoint")
    state.write_checkpoint(status, 100, path)
    summary, failed = state.read_checkpoint(spark, path)
    assert summary.collect() == [(2, 9, 100, AT, 2, None)]
    assert [r.page_num for r in failed.collect()] == [2]
    summary, failed = state.read_checkpoint(spark, path + "-none")
    assert summary.count() == failed.count() == 0


def test_saved_rows_files(spark, tmp_path):
    (tmp_path / "rows.json").write_text('[\n  {"npsn": "1", "x": "é"},\n  {"npsn": "2"}\n]', encoding="utf-8")
    (tmp_path / "bad.json").write_text("not json")

    def read(name, multi_line=True):
        return state.read_saved_rows(spark, str(tmp_path / name), ["npsn", "x"], multi_line)

    assert read("rows.json").collect() == [("1", "é"), ("2", None)]
    assert read("bad.json").count() == 0 and read("none.json").count() == 0
    files.write_saved_rows(read("rows.json"), str(tmp_path / "lines"))
    files.write_saved_rows(read("rows.json"), str(tmp_path / "lines"))
    assert read("lines", multi_line=False).count() == 4


# tables -----------------------------------------------------------------------------------------------


def test_publish_replaces_what_a_name_shows(spark):
    one = spark.createDataFrame([("1",)], "npsn STRING")
    two = spark.createDataFrame([("2",), ("3",)], "npsn STRING")
    table.publish_table(one, "shown", new_dir(spark, "t"))
    before = spark.table("shown")
    table.publish_table(two, "shown", new_dir(spark, "t"))
    assert sorted(r.npsn for r in spark.table("shown").collect()) == ["2", "3"]
    assert before.collect() == [("1",)]
    table.publish_managed_table(one, "kept")
    table.publish_managed_table(two, "kept")
    assert spark.table("kept").count() == 2


# runs -------------------------------------------------------------------------------------------------


def make_config(spark, run_id="r", pages=5, **settings):
    return RunConfig(run_id, new_dir(spark, "work"), total_rows=pages * 48, **settings)


def npsns(rows):
    return sorted((r.page_num, r.npsn) for r in rows.collect())


def test_run_with_retry(spark):
    config = make_config(spark)
    first = crawl(spark, (0, page(1, 2), True), (1, page(3), False), (2, "<p>", True), (3, None, True))
    second = crawl(spark, (1, page(3, 1), True), (0, page(9), True), (4, page(5), True))
    result = runs.run_list(spark, first, config, retries=[second])
    assert npsns(result.rows) == [(0, "1"), (0, "2"), (1, "1"), (1, "3"), (4, "5")]
    assert npsns(result.distinct_rows) == [(0, "1"), (0, "2"), (1, "3"), (4, "5")]
    totals = result.totals.first()
    assert (totals.total_rows, totals.pages_planned, totals.pages_ok, totals.pages_failed) == (5, 5, 3, 2)
    assert not result.complete
    published = csv_files.read_published_csv(spark, result.path, fv.CARD_COLUMNS).orderBy("npsn").collect()
    assert published[0] == ("1", "N1", "-", "-") and len(published) == 4


def test_every_failure_says_why(spark):
    config = make_config(spark, pages=5)
    runs.run_pass(spark, crawl(spark, (0, page(1), True), (1, page(2), False), (2, "<p>", True), (3, None, True)), config)
    found = runs._results(spark, config).orderBy("page_num").collect()
    assert [(r.page_num, r.ok, r.error) for r in found] == [
        (0, True, None), (1, False, "not loaded"), (2, False, "no rows"), (3, False, "no html"), (4, False, "no snapshot"),
    ]


def test_cut_run_ends_like_an_uninterrupted_one(spark):
    all_pages = crawl(spark, *[(n, page(n * 10, n * 10 + 1), True) for n in range(5)])
    whole = runs.run_list(spark, all_pages, make_config(spark))
    config = make_config(spark)
    runs.run_pass(spark, all_pages.where("page_num IN (0, 3)"), config)
    resumed = runs.run_list(spark, all_pages, config)
    assert npsns(resumed.rows) == npsns(whole.rows) and resumed.complete and whole.complete
    states = spark.read.parquet(config.work_dir + "/runs").collect()
    assert [(r.run_id, r.state) for r in states] == [("r", "complete")]


def test_done_pages_are_not_read_again(spark):
    config = make_config(spark, pages=2)
    runs.run_pass(spark, crawl(spark, (0, page(1), True)), config)
    runs.run_pass(spark, crawl(spark, (0, page(7), True), (1, page(2), True)), config)
    assert npsns(runs.collected_rows(spark, config)) == [(0, "1"), (1, "2")]


def test_ranges_are_committed_one_by_one(spark):
    all_pages = crawl(spark, *[(n, page(n * 10, n * 10 + 1), n != 3) for n in range(7)])
    config = make_config(spark, pages=8, pages_per_commit=3)
    runs.run_pass(spark, all_pages, config)
    base = local(f"{config.work_dir}/{config.run_id}/page_results/attempt=1")
    assert sorted(p.name for p in base.iterdir()) == ["first_page=0", "first_page=3", "first_page=6"]
    result = runs.run_list(spark, all_pages.withColumn("success", all_pages.page_num >= 0), config)
    assert npsns(result.rows) == [(n, str(n * 10 + k)) for n in range(7) for k in range(2)]
    assert not result.complete  # page 7 of the plan was never saved


def test_limits_and_early_stop(spark):
    pages = crawl(spark, (0, page(1), True), (1, page(2), False), (2, page(3), True), (3, "", True), (4, page(4), True))
    stopped = runs.run_list(spark, pages, make_config(spark, stop_at_empty_page=True))
    assert npsns(stopped.rows) == [(0, "1"), (2, "3")]
    limited = runs.run_list(spark, pages, make_config(spark, start_page=1, max_pages=2))
    assert npsns(limited.rows) == [(2, "3")]


def test_process_hook(spark):
    result = runs.run_list(
        spark, crawl(spark, (0, page(1, 2), True)), make_config(spark, pages=1), process=lambda rows: rows.where("npsn <> '1'")
    )
    assert npsns(result.rows) == [(0, "2")]


def test_latest_profile_of_a_url_counts(spark):
    cards = spark.createDataFrame(
        [(0, 0, "1", "u", "list", None, None), (0, 1, "2", None, "x", None, None)],
        "page_num INT, pos INT, npsn STRING, url STRING, nama_sekolah STRING, status_sekolah STRING, alamat_jalan STRING",
    )
    profiles = spark.createDataFrame(
        [("u", "<h1>new</h1>", datetime(2026, 2, 1)), ("u", "<h1>old</h1>", AT), ("u", None, datetime(2026, 3, 1))],
        "url STRING, html STRING, fetched_at TIMESTAMP",
    )
    config = make_config(spark)
    wide = runs.run_profiles(spark, cards, profiles, config)
    assert wide.columns == fv.PROFILE_COLUMNS
    assert [(r.npsn, r.nama_sekolah, r.guru) for r in wide.collect()] == [("1", "new", "-")]
    first = runs.run_profiles(spark, cards, profiles, make_config(spark), list_first=True)
    assert [(r.npsn, r.nama_sekolah) for r in first.collect()] == [("1", "list")]


def test_pass_reports_what_it_wrote(spark, caplog):
    with caplog.at_level("INFO", logger="pagesift.plans.run"):
        runs.run_pass(spark, crawl(spark, (0, page(1, 2), True), (1, "", True)), make_config(spark, pages=2))
    assert "pages 0 to 1" in caplog.text and "'rows': 2" in caplog.text and "'pages_ok': 1" in caplog.text


# streams ----------------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts, per_batch", [(1, None), (6, 1), (6, 4)])
def test_stream_equals_batch_for_any_split(spark, parts, per_batch):
    arrived = crawl(spark, *[(n, page(n % 4, 100 + n), n != 5) for n in range(12)])
    path = new_dir(spark, "in")
    arrived.repartition(parts, "page_num").write.parquet(path)
    out = new_dir(spark, "out")
    ingest.ingest_distinct(ingest.page_stream(spark, path, max_files=per_batch), out, new_dir(spark, "c")).awaitTermination()
    found = [r.npsn for r in spark.read.parquet(out).collect()]
    expected = {str(n % 4) for n in range(12) if n != 5} | {str(100 + n) for n in range(12) if n != 5}
    assert sorted(found) == sorted(expected)


def test_stream_goes_on_after_a_restart_without_doubling(spark):
    path, out, checkpoint = new_dir(spark, "in"), new_dir(spark, "out"), new_dir(spark, "c")
    crawl(spark, (0, page(1), True), (1, page(2), False)).write.parquet(path)
    ingest.ingest(ingest.page_stream(spark, path), out, checkpoint).awaitTermination()
    crawl(spark, (2, page(3), True)).write.mode("append").parquet(path)
    query = ingest.ingest(ingest.page_stream(spark, path), out, checkpoint)
    query.awaitTermination()
    found = sorted((r.page_num, r.ok, r.attempt) for r in spark.read.parquet(out).collect())
    assert found == [(0, True, 1), (1, False, 1), (2, True, 2)]
    assert sum(p["rows"] for p in ingest.progress(query)) == 1


def test_stream_output_is_a_resumable_run(spark):
    config = make_config(spark, pages=3)
    path = new_dir(spark, "in")
    crawl(spark, (0, page(1), True), (1, page(2), False)).write.parquet(path)
    out = f"{config.work_dir}/{config.run_id}/page_results"
    ingest.ingest(ingest.page_stream(spark, path), out, new_dir(spark, "c")).awaitTermination()
    result = runs.run_list(spark, crawl(spark, (0, page(9), True), (1, page(2), True), (2, page(3), True)), config)
    assert npsns(result.rows) == [(0, "1"), (1, "2"), (2, "3")] and result.complete


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
