"""What a run holds: the latest attempt of every page; unreadable pages, large counts and odd bytes."""

from datetime import datetime

from pagesift import fixed_values as fv
from pagesift.config import RunConfig
from pagesift.operators import pages, shape
from pagesift.plans import run
from pagesift.sources import snapshots, state



def stored_results(spark, monkeypatch, rows):
    df = spark.createDataFrame(rows, "page_num int, attempt int, ok boolean, success boolean, n_rows int, error string, card array<string>")
    pairs = df.selectExpr("page_num", "attempt", "ok", "success", "n_rows", "error", "timestamp'2024-01-01' AS ts", "card")
    monkeypatch.setattr(run, "_results", lambda s, c: pairs)
    monkeypatch.setattr(run.cd, "card_rows", lambda r, *keys: r.selectExpr("page_num", "explode(card) AS npsn"))
    return lambda **o: sorted(tuple(r) for r in run.collected_rows(spark, RunConfig("r", "/none", **o)).collect())


def test_a_page_that_came_twice_counts_once(spark, monkeypatch):
    rows = [(0, 1, True, True, 1, None, ["1"]), (0, 2, True, True, 2, None, ["1", "2"]), (1, 1, True, True, 1, None, ["3"]), (1, 2, False, False, 0, "not loaded", None)]
    assert stored_results(spark, monkeypatch, rows)() == [(0, "1"), (0, "2")]


def test_only_a_page_read_and_empty_stops(spark, monkeypatch):
    rows = [(0, 1, True, True, 1, None, ["1"]), (1, 1, False, True, 0, "bad markup", None), (2, 1, True, True, 1, None, ["3"]),
            (3, 1, False, True, 0, "no rows", None), (3, 2, True, True, 1, None, ["4"]), (4, 1, False, True, 0, "no rows", None), (5, 1, True, True, 1, None, ["6"])]
    assert stored_results(spark, monkeypatch, rows)(stop_at_empty_page=True) == [(0, "1"), (2, "3"), (3, "4")]


def test_unreadable_page_of_one_pass(spark):
    df = spark.createDataFrame([(0, True, None, 1), (1, True, "broken", 0), (2, True, None, 1), (3, True, None, 0), (4, True, None, 2)], "page_num int, success boolean, parse_error string, n_rows int")
    assert sorted(r.page_num for r in pages.until_empty_page(df).collect()) == [0, 1, 2]


def test_totals_beyond_two_billion(spark):
    status = spark.createDataFrame([(k, 1, True, 1_500_000_000, datetime(2024, 1, 1)) for k in range(2)], "page_num int, attempt int, ok boolean, n_rows int, ts timestamp")
    assert state.summary_of(status, fv.TOTAL_ROWS).first().processed_count == 3_000_000_000


def test_counts_and_ratios(spark):
    rows = [("1.5", "1:20"), ("12.0", "20 : 1"), ("1.234", "3,5"), ("3.000.000.000", "1:0"), ("x", "a:b")]
    df = spark.createDataFrame(rows, "guru string, rasio_siswa_guru string")
    assert [tuple(r) for r in shape.typed_view(df).collect()] == [(None, 0.05), (None, 20.0), (1234, 3.5), (3_000_000_000, None), (None, None)]


def test_bytes_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<p>caf\xe9</p>")
    (tmp_path / "b.html").write_bytes("<p>café</p>".encode())
    assert sorted(r.html for r in snapshots.read_html_files(spark, str(tmp_path)).collect()) == ["<p>café</p>", "<p>caf�</p>"]
