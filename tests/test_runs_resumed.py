"""Attempts of passes and streams in one order, batch files of cut runs, publishes that fail, and honest ends."""

from dataclasses import replace

import pytest
from test_files_and_runs import AT, crawl, local, make_config, npsns, page

from pagesift import fixed_values as fv
from pagesift.operators import skew
from pagesift.plans import run as runs
from pagesift.session import new_dir
from pagesift.sinks import files
from pagesift.sources import commits, csv_files
from pagesift.streaming import ingest


def test_attempts_are_handed_out_once(spark):
    folder = new_dir(spark, "results")
    assert [commits.claim_attempt(spark, folder, n) for n in ("a", "b", "a", "c", "b")] == [1, 2, 1, 3, 2]
    assert commits.names_in(spark, folder + "/none") == [] and not commits.path_exists(spark, folder + "/none")
    assert commits._create(spark, folder + "/x", "1") and not commits._create(spark, folder + "/x", "2")


def test_page_that_failed_in_a_stream_was_read_by_a_pass_and_streamed_again(spark):
    config = make_config(spark, pages=2)
    out, checkpoint, arrivals = f"{config.work_dir}/{config.run_id}/page_results", new_dir(spark, "c"), new_dir(spark, "in")

    def stream(*rows):
        crawl(spark, *rows).coalesce(1).write.mode("append").parquet(arrivals)
        ingest.ingest(ingest.page_stream(spark, arrivals), out, checkpoint).awaitTermination()

    stream((0, page(1), True), (1, page(2), False))
    runs.run_pass(spark, crawl(spark, (1, page(2), True)), config)
    stream((1, page(3), True))
    assert npsns(runs.collected_rows(spark, config)) == [(0, "1"), (1, "3")]
    attempts = sorted((r.page_num, r.attempt) for r in runs._results(spark, config).collect())
    assert attempts == [(0, 1), (1, 1), (1, 2), (1, 3)]


def test_page_twice_in_one_pass_counts_once(spark):
    config = make_config(spark, pages=2, batch_files=True)
    twice = crawl(spark, (0, page(1), True), (0, page(1), True), (1, page(2), True)).repartition(3)
    result = runs.run_list(spark, twice, config)
    assert npsns(result.rows) == [(0, "1"), (1, "2")]
    assert result.totals.first().total_rows == 2
    assert files_of(config) == {"batch_1-2": ["1", "2"]}


def files_of(config):
    """Rows of every batch file of a run."""
    found = {}
    for part in sorted(local(f"{config.work_dir}/{config.run_id}/batches").glob("commit=*/batch=*/part-*.csv")):
        found.setdefault(part.parent.name.removeprefix("batch="), []).extend(x.split(",")[0] for x in part.read_text("utf-8-sig").split()[1:])
    return found


@pytest.mark.parametrize("cut", [None, 2, 5])
def test_batches_of_a_cut_run_are_those_of_a_whole_one(spark, cut):
    pages = crawl(spark, *[(n, page(*range(10 * n, 10 * n + n % 4)), n != 3) for n in range(8)])
    config = make_config(spark, pages=8, pages_per_commit=3, batch_files=True, batch_size=4)
    if cut:
        runs.run_pass(spark, pages, replace(config, last_page=cut))
        first = files_of(config)
    result = runs.run_list(spark, pages, config, retries=[pages.withColumn("success", pages.page_num >= 0)])
    assert not result.complete  # pages 0 and 4 hold nothing
    rows = [str(10 * n + k) for n in (1, 2, 5, 6, 7, 3) for k in range(n % 4)]
    assert files_of(config) == {f"batch_{k + 1}-{k + 4}": rows[k : k + 4] for k in range(0, len(rows) - 3, 4)}
    if cut:
        assert first.items() <= files_of(config).items()


def test_a_complete_run_writes_its_last_batch_once(spark):
    pages = crawl(spark, (0, page(1, 2, 3), True), (1, page(4, 5), True))
    config = make_config(spark, pages=2, batch_files=True, batch_size=3)
    for _ in range(2):
        assert runs.run_list(spark, pages, config).complete
        assert files_of(config) == {"batch_1-3": ["1", "2", "3"], "batch_4-5": ["4", "5"]}


def test_a_failed_publish_leaves_the_one_before(spark, monkeypatch):
    config = make_config(spark, pages=2)
    runs.run_list(spark, crawl(spark, (0, page(1), True)), config)
    before = runs.published_path(spark, config)

    def fail(rows, path, order):
        files.write_csv(rows.limit(0), path)
        raise RuntimeError("cut")

    monkeypatch.setattr(runs, "write_csv_in_order", fail)
    with pytest.raises(RuntimeError):
        runs.run_list(spark, crawl(spark, (1, page(2), True)), config)
    assert runs.published_path(spark, config) == before
    assert [r.npsn for r in csv_files.read_published_csv(spark, before, fv.CARD_COLUMNS).collect()] == ["1"]
    monkeypatch.undo()
    assert runs.run_list(spark, crawl(spark, (1, page(2), True)), config).complete
    assert csv_files.read_published_csv(spark, runs.published_path(spark, config), fv.CARD_COLUMNS).count() == 2


def test_stamped_paths_do_not_meet(spark):
    folder = new_dir(spark, "published")
    first = files.new_publish_path(spark, folder, AT)
    files.write_csv(spark.createDataFrame([("1",)], "npsn STRING"), first)
    assert files.new_publish_path(spark, folder, AT) == first + "_2"


def test_a_run_that_ends_at_its_empty_page_is_complete(spark):
    pages = crawl(spark, (0, page(1), True), (1, page(2), True), (2, "", True), (3, page(3), False))
    assert runs.run_list(spark, pages, make_config(spark, stop_at_empty_page=True)).complete
    failed_before = crawl(spark, (0, page(1), False), (1, page(2), True), (2, "", True))
    assert not runs.run_list(spark, failed_before, make_config(spark, stop_at_empty_page=True)).complete
    assert not runs.run_list(spark, pages, make_config(spark, pages=4)).complete


def test_unreadable_profiles_are_told(spark):
    cards = spark.createDataFrame(
        [(0, k, str(k), url, "n", None, None) for k, url in enumerate(["a", "b", "c", None])],
        "page_num INT, pos INT, npsn STRING, url STRING, nama_sekolah STRING, status_sekolah STRING, alamat_jalan STRING",
    )
    config = make_config(spark)

    def run(*pages):
        wide = runs.run_profiles(spark, cards, spark.createDataFrame(list(pages), "url STRING, html STRING"), config)
        path = runs.published_path(spark, config)
        state = max(spark.read.parquet(config.work_dir + "/runs").collect(), key=lambda r: r.ts).state
        rejects = sorted(tuple(r) for r in spark.read.parquet(path + "/rejects").collect())
        assert csv_files.read_published_csv(spark, path + "/csv", fv.PROFILE_COLUMNS).count() == wide.count()
        return sorted(r.url for r in wide.collect()), rejects, state

    assert run(("a", None), ("b", None)) == ([], [("a", "no html"), ("b", "no html"), ("c", "no snapshot")], "partial")
    assert run(("a", "<h1>x</h1>"), ("b", None)) == (["a"], [("b", "no html"), ("c", "no snapshot")], "partial")
    assert run(("a", None), ("b", "<p>"), ("c", "<p>")) == (["a", "b", "c"], [], "complete")


def test_hot_keys_come_from_a_bounded_sample(spark):
    rows = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS url")
    assert [r.url for r in skew.hot_keys(rows, "url", sampled=5_000).collect()] == ["hot"]
