"""Whole runs over snapshot tables: list pages to rows, and list plus profile pages to wide rows.

Every pass appends one table, ``page_results``: the outcome of each page together with its
cards. That table is the checkpoint, so a run that was cut goes on where the table ends, and a
retry is simply another pass over what is still open.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift import fixed_values as fv
from pagesift.config import RunConfig
from pagesift.operators import cards as cd
from pagesift.operators import merge, older_profile, pages, profile, shape
from pagesift.operators.metrics import observed, run_totals
from pagesift.plans import batches
from pagesift.session import stored
from pagesift.sinks.files import new_publish_path, write_csv_in_order, write_wide_table
from pagesift.sources.commits import claim_attempt, path_exists
from pagesift.sources.html_nodes import with_nodes
from pagesift.sources.page_plan import page_bounds
from pagesift.sources.state import PAGE_STATUS, latest_records, latest_status, listed_failures, read_table, strings_schema

CARDS = T.ArrayType(
    T.StructType().add("pos", T.IntegerType()).add("card", strings_schema(fv.CARD_COLUMNS))
)
PAGE_RESULTS = (
    T.StructType()
    .add("page_num", T.IntegerType())
    .add("ok", T.BooleanType())
    .add("success", T.BooleanType())
    .add("n_rows", T.IntegerType())
    .add("error", T.StringType())
    .add("ts", T.TimestampType())
    .add("cards", CARDS)
    .add("row", T.LongType())
    .add("attempt", T.IntegerType())
)
PROFILE_RESULTS = (
    T.StructType([T.StructField("fetched_at", T.TimestampType()), *strings_schema(["reason", *fv.PROFILE_COLUMNS]).fields])
    .add("attempt", T.IntegerType())
    .add("range", T.IntegerType())
    .add("outcome", T.StringType())
)
BROADCAST_URLS = 2_000_000
RUNS = (
    T.StructType()
    .add("run_id", T.StringType())
    .add("state", T.StringType())
    .add("path", T.StringType())
    .add("ts", T.TimestampType())
)

log = logging.getLogger(__name__)

RowHook = Callable[[DataFrame], DataFrame]


@dataclass
class RunResult:
    """Rows as collected, rows without repeated identifiers, and where they were published."""

    rows: DataFrame
    distinct_rows: DataFrame
    totals: DataFrame
    path: str
    complete: bool


def page_results(snapshots: DataFrame, record=cd.card_record) -> DataFrame:
    """Outcome and cards of every snapshot: a map over the pages, without a shuffle.

    A page that was not loaded gives no rows whatever has come of it, so what has come is not parsed.
    """
    loaded = F.when(F.col("success"), F.col("html")).alias("html")
    read = cd.with_cards(with_nodes(snapshots.select("page_num", loaded, "success", "fetched_at")), record)
    return pages.with_outcome(read).select(
        "page_num",
        "ok",
        "success",
        "n_rows",
        F.expr(
            "CASE WHEN ok THEN NULL WHEN success IS NOT TRUE THEN 'not loaded'"
            " WHEN parse_error IS NOT NULL THEN parse_error ELSE 'no rows' END"
        ).alias("error"),
        F.col("fetched_at").cast("timestamp").alias("ts"),
        "cards",
        F.monotonically_increasing_id().alias("row"),
    )


def _results(spark: SparkSession, config: RunConfig) -> DataFrame:
    return read_table(spark, f"{config.work_dir}/{config.run_id}/page_results", PAGE_RESULTS)


def _status(results: DataFrame) -> DataFrame:
    return latest_status(results.select(*PAGE_STATUS.names, *[c for c in ("row",) if c in results.columns]))


def _ranges(config: RunConfig) -> list[tuple[int, int]]:
    start, end = page_bounds(config)
    step = config.pages_per_commit or max(end - start, 1)
    return [(low, min(low + step, end)) for low in range(start, end, step)]


def run_pass(spark: SparkSession, snapshots: DataFrame, config: RunConfig) -> int:
    """Read all pages that are still open from ``snapshots``; returns the number of the pass.

    Of a page that ``snapshots`` has more than once, one record counts. With ``pages_per_commit`` each range of pages is
    one job with its own commit; keep the snapshots in page order then, so that a range reads only its own part of the
    files. The number of the pass comes from the order of attempts that streams into the same run share.
    """
    folder = f"{config.work_dir}/{config.run_id}/page_results"
    attempt = claim_attempt(spark, folder, f"pass {uuid.uuid4().hex}")
    begun = attempt > 1 or path_exists(spark, f"{folder}/attempt=0")
    status = _status(_results(spark, config)) if begun else None
    for low, high in _ranges(config):
        in_range = (F.col("page_num") >= low) & (F.col("page_num") < high)
        wanted = snapshots.where(in_range)
        open_pages = spark.range(low, high).select(F.col("id").cast("int").alias("page_num"))
        if status is not None:
            before = status.where(in_range)
            open_pages = pages.pending_pages(open_pages, before)
            wanted = pages.without_done(wanted, before)
        path = f"{folder}/attempt={attempt}/first_page={low}"
        watch = Observation()
        observed(page_results(wanted), watch).write.mode("overwrite").parquet(path)
        log.info("pass %d, pages %d to %d: %s", attempt, low, high - 1, watch.get)
        seen = spark.read.schema(PAGE_RESULTS).parquet(path).select("page_num")
        unseen = open_pages.join(seen, "page_num", "left_anti").select(
            "page_num",
            F.lit(False).alias("ok"),
            F.lit(False).alias("success"),
            F.lit(0).alias("n_rows"),
            F.lit("no snapshot").alias("error"),
            F.lit(None).cast("timestamp").alias("ts"),
            F.lit(None).cast(CARDS).alias("cards"),
            F.lit(-1).cast("long").alias("row"),
        )
        unseen.write.mode("append").parquet(path)
        if config.batch_files:
            batches.write_filled_batches(spark, config, PAGE_RESULTS)
    return attempt


def resume_from_summary(spark: SparkSession, config: RunConfig, summary: DataFrame, saved_rows: DataFrame) -> None:
    """Begin a run where another program's checkpoint ended: its pages are attempt 0, its rows come before all others.

    ``summary`` is what ``read_summary`` or ``read_checkpoint`` gave: pages up to ``last_page`` are done but for those in
    ``failed_pages``. Saved rows do not say which page they came from; they are kept as a table of their own.
    Without a usable summary nothing is seeded, and all pages are open. Call it before the first pass.
    """
    base = f"{config.work_dir}/{config.run_id}"
    start, end = page_bounds(config)
    planned = spark.range(start, end).select(F.col("id").cast("int").alias("page_num"))
    last = summary.agg(F.max("last_page").alias("last")).first().last
    failed = listed_failures(summary).distinct().withColumn("failed", F.lit(True))
    seen = planned.where(F.col("page_num") <= (last if last is not None else -1)).join(failed, "page_num", "left")
    ok = F.col("failed").isNull()
    seeded = seen.select(
        "page_num",
        ok.alias("ok"),
        ok.alias("success"),
        F.lit(0).alias("n_rows"),
        F.when(~ok, "failed before").alias("error"),
        F.lit(None).cast("timestamp").alias("ts"),
        F.lit(None).cast(CARDS).alias("cards"),
        F.lit(-1).cast("long").alias("row"),
    )
    seeded.write.mode("overwrite").parquet(f"{base}/page_results/attempt=0/first_page={start}")
    kept = saved_rows.select(F.monotonically_increasing_id().alias("place"), *fv.CARD_COLUMNS)
    kept.write.mode("overwrite").parquet(f"{base}/saved_rows")


SAVED = T.StructType([T.StructField("place", T.LongType()), *strings_schema(fv.CARD_COLUMNS).fields])
SAVED_PAGE = -1  # stands for the page of rows that a checkpoint brought


def collected_rows(spark: SparkSession, config: RunConfig) -> DataFrame:
    """One row per card of all pages, with ``page_num`` and ``pos``; of each page the latest attempt counts.

    A page whose latest attempt failed gives no rows, as in the totals. Rows that a checkpoint brought come first, as page
    -1.
    """
    results = latest_records(_results(spark, config))
    if config.stop_at_empty_page:
        results = pages.until_empty_page(results)
    rows = cd.card_rows(results.where("ok"), "page_num")
    saved_path = f"{config.work_dir}/{config.run_id}/saved_rows"
    if not path_exists(spark, saved_path):
        return rows
    saved = spark.read.schema(SAVED).parquet(saved_path)
    return saved.select(F.lit(SAVED_PAGE).alias("page_num"), F.col("place").alias("pos"), *fv.CARD_COLUMNS).unionByName(
        rows.withColumn("pos", F.col("pos").cast("long"))
    )


def is_complete(spark: SparkSession, config: RunConfig) -> bool:
    """Whether every page that the run should bring is there: all planned ones, or those before the page it stops at."""
    start, end = page_bounds(config)
    planned = _results(spark, config).where((F.col("page_num") >= start) & (F.col("page_num") < end))
    records = latest_records(planned.drop("cards", "ts"))
    if config.stop_at_empty_page:
        read_empty = records.where(F.col("success") & (F.col("error") == pages.NO_ROWS))
        end = min(end, pages.first_empty(read_empty).first().stop)
    return records.where((F.col("page_num") < end) & F.col("ok")).count() == max(end - start, 0)


def run_list(
    spark: SparkSession,
    snapshots: DataFrame,
    config: RunConfig,
    retries: list[DataFrame] | None = None,
    process: RowHook = lambda rows: rows,
) -> RunResult:
    """List pages to the published four-column table.

    ``snapshots`` has ``page_num, html, success, fetched_at``. Each table in ``retries`` is a
    later fetch of the pages that were still open. ``process`` may change the rows before they
    are published.
    """
    for fetched in [snapshots, *(retries or [])]:
        run_pass(spark, fetched, config)
    rows = process(collected_rows(spark, config))
    distinct_rows = shape.keep_first(rows)
    complete = is_complete(spark, config)
    if config.batch_files:
        batches.write_filled_batches(spark, config, PAGE_RESULTS, close=complete)
    path = new_publish_path(spark, f"{config.work_dir}/{config.run_id}/published", datetime.now(timezone.utc))
    write_csv_in_order(distinct_rows.select("page_num", "pos", *fv.CARD_COLUMNS), path, ["page_num", "pos"])
    close_run(spark, config, path, "complete" if complete else "partial")
    return RunResult(rows, distinct_rows, run_totals(_status(_results(spark, config))), path, complete)


def published_path(spark: SparkSession, config: RunConfig) -> str | None:
    """Where the run's rows were published last. A publish that was cut has no entry, so the one before it still counts."""
    entries = read_table(spark, f"{config.work_dir}/runs", RUNS).where(F.col("run_id") == config.run_id)
    return entries.agg(F.max_by("path", "ts")).first()[0]


def close_run(spark: SparkSession, config: RunConfig, path: str, state: str) -> None:
    """Record the state of a run and the path of its publish; called only after that publish was committed."""
    row = spark.createDataFrame([(config.run_id, state, path, datetime.now(timezone.utc))], RUNS)
    row.write.mode("append").parquet(f"{config.work_dir}/runs")


def run_profile_pass(spark: SparkSession, snapshots: DataFrame, config: RunConfig, list_first: bool = False) -> int:
    """Read the profile pages that no pass before has read; what each says, or why it says nothing, is appended.

    One parse feeds both: details and rejects are one write, parted by outcome. URLs that are done go out by their names,
    of which up to ``BROADCAST_URLS`` are sent to the pages; HTML is shuffled only beyond that.
    """
    folder = f"{config.work_dir}/{config.run_id}/profile_results"
    attempt = claim_attempt(spark, folder, f"pass {uuid.uuid4().hex}")
    fetched = F.col("fetched_at").cast("timestamp") if "fetched_at" in snapshots.columns else F.lit(None).cast("timestamp")
    wanted = snapshots.select("url", "html", fetched.alias("fetched_at")).where(F.col("url").isNotNull())
    if attempt > 1:
        done = _profile_results(spark, config).where("outcome = 'ok'").select("url").distinct()
        wanted = wanted.join(F.broadcast(done) if done.count() <= BROADCAST_URLS else done, "url", "left_anti")
    for part in range(config.profile_ranges):
        in_range = F.pmod(F.xxhash64("url"), F.lit(config.profile_ranges)) == part
        parsed = with_nodes(wanted.where(in_range) if config.profile_ranges > 1 else wanted)
        if list_first:
            details = older_profile.older_details(parsed, "fetched_at", "parse_error", rejected=True)
        else:
            details = profile.profile_details(parsed, config.site, "fetched_at", "parse_error", rejected=True)
        outcome = F.when(F.col("parse_error").isNull(), "ok").otherwise("rejected").alias("outcome")
        rows = details.select("fetched_at", F.col("parse_error").alias("reason"), *fv.PROFILE_COLUMNS, outcome)
        path = f"{folder}/attempt={attempt}/range={part}"
        rows.write.mode("overwrite").partitionBy("outcome").parquet(path)
    return attempt


def _profile_results(spark: SparkSession, config: RunConfig) -> DataFrame:
    return read_table(spark, f"{config.work_dir}/{config.run_id}/profile_results", PROFILE_RESULTS)


def profile_rejects(spark: SparkSession, cards: DataFrame, config: RunConfig) -> DataFrame:
    """``url, reason`` of every listed profile that no pass could read; a page that nobody saved has the reason so."""
    results = _profile_results(spark, config)
    listed = cards.select("url").where(F.col("url").isNotNull() & (F.col("url") != "")).distinct()
    left = listed.join(results.where("outcome = 'ok'").select("url"), "url", "left_anti")
    last = results.where("outcome = 'rejected'").groupBy("url").agg(F.max_by("reason", F.struct("attempt", "fetched_at")).alias("reason"))
    return left.join(last, "url", "left").select("url", F.coalesce("reason", F.lit("no snapshot")).alias("reason"))


def run_profiles(
    spark: SparkSession,
    cards: DataFrame,
    profile_snapshots: DataFrame,
    config: RunConfig,
    list_first: bool = False,
    process: RowHook = lambda rows: rows,
) -> DataFrame:
    """Cards with a URL and the profile pages behind them to the published 39-column table.

    ``cards`` has the five profile-card columns, ``page_num`` and ``pos``; ``profile_snapshots``
    has ``url, html``, and ``fetched_at`` if a URL may have been saved more than once: the latest
    page that can be read counts then. A call with the same run goes on: pages that were read are not read again.
    The wide rows, their widths, the same as CSV in the cards' order, and the rejected profiles are published in one
    folder. The run is complete when no listed profile is missing.
    """
    base = f"{config.work_dir}/{config.run_id}"
    run_profile_pass(spark, profile_snapshots, config, list_first)
    read = _profile_results(spark, config).where("outcome = 'ok'")
    details = shape.keep_last(read.select("fetched_at", "attempt", *fv.PROFILE_COLUMNS), "url", ("fetched_at", "attempt"))
    stored_details = stored(details.select(*fv.PROFILE_COLUMNS), "details")
    stored_cards = stored(cards, "profile-cards")
    merged = merge.merge_list_first if list_first else merge.merge_detail_first
    rows = process(merged(stored_cards, stored_details, "page_num", "pos"))
    rows = stored(rows.select("page_num", "pos", *fv.PROFILE_COLUMNS), "merged")
    path = new_publish_path(spark, base + "/wide", datetime.now(timezone.utc))
    write_wide_table(rows.select(*fv.PROFILE_COLUMNS).na.fill(fv.MISSING), path)
    write_csv_in_order(rows, path + "/csv", ["page_num", "pos"])
    profile_rejects(spark, stored_cards, config).write.parquet(path + "/rejects")
    complete = spark.read.parquet(path + "/rejects").isEmpty()
    close_run(spark, config, path, "complete" if complete else "partial")
    return spark.read.parquet(path + "/rows")


def run_directory(
    spark: SparkSession,
    list_snapshots: DataFrame,
    opened: DataFrame,
    profile_snapshots: DataFrame,
    config: RunConfig,
    retries: list[DataFrame] | None = None,
    list_first: bool = False,
    process: RowHook = lambda rows: rows,
) -> DataFrame:
    """The whole way from list pages to wide rows: list run, the profiles that its cards led to, merge, publish.

    ``opened`` has ``page_num, pos, observed_url, list_url``: where a card led when it was opened. A call with the same
    run goes on where the last one ended, in its list pages as in its profiles.
    """
    listed = run_list(spark, list_snapshots, config, retries)
    cards = cd.opened_cards(listed.rows, opened, ["page_num", "pos"])
    return run_profiles(spark, cards, profile_snapshots, config, list_first, process)
