"""Saved files in other charsets, runs that begin at a checkpoint, first arrivals and progress of streams."""

import json
from datetime import timedelta

import pytest
from test_files_and_runs import AT, SNAPSHOT, crawl, make_config, npsns, page

from pagesift import fixed_values as fv
from pagesift.plans import run as runs
from pagesift.session import new_dir
from pagesift.sources import snapshots, state
from pagesift.streaming import ingest


def test_charsets_of_files(spark, tmp_path):
    text = "<p>café – “x” €</p>"
    saved = {
        "plain": text.encode(),
        "mark8": b"\xef\xbb\xbf" + text.encode(),
        "mark16be": b"\xfe\xff" + text.encode("utf-16-be"),
        "mark16le": b"\xff\xfe" + text.encode("utf-16-le"),
        "meta": b'<META CHARSET = "windows-1252">' + text.encode("cp1252"),
        "http": b'<meta http-equiv="Content-Type" content="text/html; charset=iso-8859-1">' + text.encode("cp1252"),
        "wrong": b'<meta charset="utf-16">' + text.encode(),
        "space": b" ",
    }
    for name, data in saved.items():
        (tmp_path / f"{name}.html").write_bytes(data)
    found = {r.url.rsplit("/", 1)[1][:-5]: (r.html, r.charset) for r in snapshots.read_html_files(spark, str(tmp_path)).collect()}
    for name, (html, _) in found.items():
        assert html.endswith(text) or name == "space" and html == " "
    assert found["meta"][1] == found["http"][1] == "windows-1252" and found["wrong"][1] == "utf-8"


def test_files_as_snapshots(spark, tmp_path):
    for name in ("list_0.html", "2024-list-7.html", "none.html", "99999999999.html"):
        (tmp_path / name).write_text(" \n" if "7" in name else page(1))
    rows = snapshots.list_snapshots(snapshots.read_html_files(spark, str(tmp_path))).collect()
    assert sorted((r.page_num, r.success) for r in rows) == [(0, True), (7, False)]


@pytest.mark.parametrize("usable", [True, False])
def test_run_from_a_checkpoint_file(spark, tmp_path, usable):
    summary = {"last_page": 2, "processed_count": 3, "total_count": 5, "timestamp": "2024-05-06T07:08:09", "processed_pages": 2, "failed_pages": [1]}
    (tmp_path / "summary.json").write_text(json.dumps(summary) if usable else "{")
    (tmp_path / "rows.json").write_text(json.dumps([{"npsn": "1", "nama_sekolah": "a"}, {"npsn": "2"}, {"npsn": "1", "nama_sekolah": "b"}]))
    config = make_config(spark, pages=4)
    saved = state.read_saved_rows(spark, str(tmp_path / "rows.json"), fv.CARD_COLUMNS, multi_line=True)
    runs.resume_from_summary(spark, config, state.read_summary(spark, str(tmp_path / "summary.json")), saved)
    result = runs.run_list(spark, crawl(spark, *[(n, page(n + 10), True) for n in range(4)]), config)
    new = [(1, "11"), (3, "13")] if usable else [(n, str(n + 10)) for n in range(4)]
    assert npsns(result.rows) == [(-1, "1"), (-1, "1"), (-1, "2"), *new]
    assert result.complete
    first = {r.npsn: r.nama_sekolah for r in result.distinct_rows.collect()}
    assert first["1"] == "a"


def test_first_arrival_is_the_first(spark):
    def arrived(minutes, n, *ids):
        cards = "".join(f"<article>NPSN : {i}<h3>page {n}</h3></article>" for i in ids)
        return n, cards, True, None if minutes is None else AT + timedelta(minutes=minutes)

    path, out, checkpoint = new_dir(spark, "in"), new_dir(spark, "out"), new_dir(spark, "c")
    batches = [[arrived(5, 1, 1, 2), arrived(3, 9, 1, 1, 3), arrived(None, 0, 3, 4), arrived(5, 0, 2)], [arrived(0, 2, 1, 5)]]
    for rows in batches:
        spark.createDataFrame(rows, SNAPSHOT).repartition(4).write.mode("append").parquet(path)
        ingest.ingest_distinct(ingest.page_stream(spark, path), out, checkpoint).awaitTermination()
    found = {r.npsn: (r.page_num, r.pos) for r in spark.read.parquet(out).collect()}
    assert found == {"1": (9, 0), "2": (0, 0), "3": (9, 2), "4": (0, 1), "5": (2, 1)}


def test_progress_of_a_stream(spark):
    path, out, checkpoint = new_dir(spark, "in"), new_dir(spark, "out"), new_dir(spark, "c")
    assert ingest.live_progress(spark, out).count() == 0
    for rows in ([(0, page(1, 2), True), (1, "", True)], [(2, page(3), True)]):
        crawl(spark, *rows).write.mode("append").parquet(path)
        ingest.ingest(ingest.page_stream(spark, path), out, checkpoint, pages_planned=4).awaitTermination()
    rows = ingest.live_progress(spark, out).orderBy("attempt").collect()
    assert [(r.pages, r.pages_ok, r.rows, r.total_pages, r.total_rows, r.percent) for r in rows] == [(2, 1, 2, 2, 2, 25.0), (1, 1, 1, 3, 3, 50.0)]
