"""CSV and table files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift import fixed_values as fv
from pagesift.operators.metrics import column_widths
from pagesift.sinks.many_files import local_path, write_lines
from pagesift.sources.commits import path_exists


def stamped_name(at: datetime, prefix: str = "data_sekolah") -> str:
    return f"{prefix}_{at:%Y%m%d_%H%M%S}"


def stamp(at: Column) -> Column:
    """The same stamp as a column."""
    return F.concat(F.lit("data_sekolah_"), F.date_format(at, fv.TIMESTAMP_FORMAT))


# comma, doubled quotes, cells as they are
_CELLS = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _csv(rows: DataFrame):
    """Comma, header, doubled quotes, and a byte order mark at the start of every file."""
    first = rows.columns[0]
    return rows.withColumnRenamed(first, fv.BOM + first).write.mode("overwrite").option("header", True).options(**_CELLS)


def write_csv(rows: DataFrame, path: str) -> str:
    """A folder of CSV part files, one per task: no row passes through a single writer."""
    _csv(rows.na.fill(fv.MISSING)).csv(path)
    return path


def new_publish_path(spark: SparkSession, folder: str, at: datetime) -> str:
    """A path that no publish has used: the stamp of the time, and a number where that second has one already."""
    path, number = f"{folder}/{stamped_name(at)}", 1
    while path_exists(spark, path):
        number += 1
        path = f"{folder}/{stamped_name(at)}_{number}"
    return path


def write_csv_in_order(rows: DataFrame, path: str, order: list[str]) -> str:
    """CSV part files whose numbers follow ``order``: rows are dealt by range, so no task sorts more than its share.

    The columns of ``order`` are not written.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(*order)
    return write_csv(placed, path)


def write_batches(batches: DataFrame, path: str, batches_per_folder: int = 1) -> str:
    """Batch files, in a folder named after the rows they hold.

    One folder per batch is the documented layout. A table of billions of rows would have
    too many of them, so ``batches_per_folder`` packs neighbours together; the rows then keep
    their batch label.
    """
    if batches_per_folder == 1:
        placed = batches.withColumn("batch", F.col("batch_label"))
        dropped = ["row_num", "batch_id", "batch_label"]
    else:
        group = F.expr(f"batch_id div {batches_per_folder}")
        low = group * batches_per_folder
        placed = batches.withColumn(
            "batch", F.concat(F.lit("batches_"), low, F.lit("-"), low + (batches_per_folder - 1))
        )
        dropped = ["row_num", "batch_id"]
    lineage = [c for c in ("page_num", "pos") if c in batches.columns]
    # a folder name that cannot be NULL lets the writer keep the order made here
    placed = placed.withColumn("batch", F.coalesce("batch", F.lit("")))
    rows = placed.repartition("batch").sortWithinPartitions("batch", "row_num").drop(*dropped, *lineage).na.fill(fv.MISSING)
    if local_path(rows.sparkSession, path) is None:
        _csv(rows).partitionBy("batch").csv(path)
        return path
    columns = [c for c in rows.columns if c != "batch"]
    header = fv.BOM + ",".join(columns) + "\n"
    write_lines(rows.select("batch", F.to_csv(F.struct(*columns), _CELLS).alias("line")), path, header, ".csv")
    return path


def write_pages(pages: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """HTML as text files, one for every page in a folder ``page=number``; ``pages`` has ``page, html``, every page once."""
    if local_path(pages.sparkSession, path) is not None:
        write_lines(pages.select("page", "html"), path, encoding=encoding)
        return path
    plain = {"quote": "", "escapeQuotes": "false", "sep": "\u0001", "emptyValue": "", **{k: _CELLS[k] for k in _CELLS if k.startswith("ignore")}}
    pages.select("page", "html").write.mode("overwrite").partitionBy("page").options(encoding=encoding, **plain).csv(path)
    return path


def write_wide_table(rows: DataFrame, path: str) -> str:
    """The wide table in parquet, with the display widths of its columns beside it."""
    rows.write.mode("overwrite").parquet(path + "/rows")
    column_widths(rows).write.mode("overwrite").parquet(path + "/widths")
    return path


def write_saved_rows(rows: DataFrame, path: str) -> str:
    """Export of rows as JSON lines, new rows appended and old ones left alone."""
    rows.write.mode("append").json(path)
    return path
