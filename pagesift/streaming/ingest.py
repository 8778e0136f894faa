"""The same flow over page files as they arrive."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pagesift.operators.cards import card_rows, with_cards
from pagesift.operators.metrics import observed
from pagesift.plans.run import page_results
from pagesift.sources.commits import claim_attempt
from pagesift.sources.html_nodes import with_nodes
from pagesift.sources.state import read_table

SNAPSHOT = (
    T.StructType()
    .add("page_num", T.IntegerType())
    .add("html", T.StringType())
    .add("success", T.BooleanType())
    .add("fetched_at", T.TimestampType())
)
PROGRESS = (
    T.StructType()
    .add("batch_number", T.LongType())
    .add("attempt", T.IntegerType())
    .add("pages", T.LongType())
    .add("pages_ok", T.LongType())
    .add("rows", T.LongType())
    .add("pages_planned", T.LongType())
    .add("ts", T.TimestampType())
)
PROGRESS_DIR = "_progress"
# identifiers a task remembers before the shuffle; forgetting them only lets more rows through
REMEMBERED = 100_000
# stands for the first page of a streamed batch; those of batch passes are never negative
STREAMED = -1
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def page_stream(
    spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT, max_files: int | None = None
) -> DataFrame:
    """Snapshot files of a folder; ``max_files`` bounds one micro-batch, and so the commit interval."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def ingest(stream: DataFrame, out: str, checkpoint: str, pages_planned: int | None = None) -> StreamingQuery:
    """Append the outcome and cards of every arriving page, failed pages included.

    Each micro-batch asks for a number among the attempts of the run, in which passes take theirs as well, and writes the
    folder of that number. A batch that is replayed finds its number again and overwrites its folder, so a restart
    neither loses nor doubles a page. What a batch brought is counted while it is written and kept beside the results,
    for :func:`live_progress`; ``pages_planned`` is the run's number of pages.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        attempt = claim_attempt(spark, out, f"stream {checkpoint} batch {number}")
        watch = Observation()
        observed(page_results(batch), watch).write.mode("overwrite").parquet(f"{out}/attempt={attempt}/first_page={STREAMED}")
        seen = watch.get
        entry = (number, attempt, seen["pages"], seen["pages_ok"], seen["rows"], pages_planned, datetime.now(timezone.utc))
        entries = spark.createDataFrame([entry], PROGRESS).coalesce(1)
        entries.write.mode("overwrite").parquet(f"{out}/{PROGRESS_DIR}/batch={attempt}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_progress(spark: SparkSession, out: str) -> DataFrame:
    """One row per micro-batch so far: its pages and rows, and the pages, rows and percent of the plan up to it.

    One row per micro-batch is added up in one place; nothing here grows with the pages.
    """
    entries = read_table(spark, f"{out}/{PROGRESS_DIR}", PROGRESS)
    so_far = Window.orderBy("attempt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    percent = F.when(F.col("pages_planned") > 0, F.col("total_pages_ok") * 100.0 / F.col("pages_planned"))
    return (
        entries.select(*PROGRESS.names)
        .withColumn("total_pages", F.sum("pages").over(so_far))
        .withColumn("total_pages_ok", F.sum("pages_ok").over(so_far))
        .withColumn("total_rows", F.sum("rows").over(so_far))
        .withColumn("percent", percent.cast("double"))
    )


def _earliest(rows: Iterator[pa.RecordBatch], remembered: int | None) -> Iterator[pa.RecordBatch]:
    """Of every identifier the row that came first by ``fetched_at``, page and position, among those of this task.

    With ``remembered``, what was found is sent on whenever so many identifiers are held, so an identifier may be sent
    more than once.
    """
    best: dict[str, tuple] = {}
    schema = None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([row for _, row in best.values()], schema=schema)

    for batch in rows:
        schema = batch.schema
        for row in batch.to_pylist():
            at = row["fetched_at"]
            place = (at is None, at, row["page_num"], row["pos"]) if at is not None else (True, row["page_num"], row["pos"])
            held = best.get(row["npsn"])
            if held is None or place < held[0]:
                best[row["npsn"]] = place, row
        if remembered and len(best) > remembered:
            yield out()
            best.clear()
    if best:
        yield out()


def first_arrivals(stream: DataFrame) -> DataFrame:
    """One row per identifier: that of the first micro-batch which has it, and in it the first by ``fetched_at`` (rows
    without it last), page and position.

    Each task thins out its own rows before the shuffle, so an identifier that fills a third of the stream does not send
    a third of its rows to one task; behind the shuffle the first one of the micro-batch is chosen, and the state drops
    identifiers of earlier ones. The state holds every identifier seen, since nothing on a record says when one can be
    forgotten; with RocksDB it lives on disk and is split over the shuffle partitions.
    """
    pages = with_cards(with_nodes(stream.where("success").select("page_num", "fetched_at", "html")))
    rows = card_rows(pages.where(F.col("parse_error").isNull()), "page_num", "fetched_at")
    thinned = rows.mapInArrow(lambda b: _earliest(b, REMEMBERED), rows.schema)
    first = thinned.repartition("npsn").mapInArrow(lambda b: _earliest(b, None), rows.schema)
    return first.dropDuplicates(["npsn"])


def ingest_distinct(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write first arrivals to a parquet folder."""
    conf, key = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key)
    conf.set(key, ROCKSDB)  # the query keeps the settings it was started with
    query = (
        first_arrivals(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    conf.set(key, before)
    return query


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and rate of every micro-batch of a query, for a live display."""
    return [
        {"batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond}
        for p in query.recentProgress
    ]
