"""Run state: page outcomes in a table, and readers and writers for the JSON summary and saved rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.sources.commits import path_exists

PAGE_STATUS = (
    T.StructType()
    .add("page_num", T.IntegerType())
    .add("attempt", T.IntegerType())
    .add("ok", T.BooleanType())
    .add("n_rows", T.IntegerType())
    .add("ts", T.TimestampType())
)
SUMMARY = (
    T.StructType()
    .add("last_page", T.IntegerType())
    .add("processed_count", T.LongType())
    .add("total_count", T.IntegerType())
    .add("timestamp", T.TimestampNTZType())
    .add("processed_pages", T.IntegerType())
    .add("failed_pages", T.ArrayType(T.IntegerType()))
)


def strings_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table that may not have been written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


# local time as ISO text, with or without a fraction
ISO_READ = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
ISO_WRITE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _read_json(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """Records of JSON files; a missing file gives no rows and a broken record gives none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("timestampNTZFormat", ISO_READ)
        .json(path)
    )
    return rows.na.drop("all")  # what could not be read arrives as a row of NULLs


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The checkpoint summary: one row, or none if there is no usable file."""
    return _read_json(spark, path, SUMMARY, multi_line=True)


def read_saved_rows(spark: SparkSession, path: str, columns: list[str], multi_line: bool = False) -> DataFrame:
    """Rows saved as JSON lines, or with ``multi_line`` as one JSON array of records per file.

    A file with an array cannot be split, so it is read by one task; lines are the format to
    save in.
    """
    return _read_json(spark, path, strings_schema(columns), multi_line)


def summary_of(status: DataFrame, total_rows: int) -> DataFrame:
    """Checkpoint summary over the latest outcome of every page: one row of fixed size."""
    return latest_status(status).agg(
        F.max("page_num").alias("last_page"),
        F.sum("n_rows").cast("long").alias("processed_count"),
        F.lit(total_rows).alias("total_count"),
        F.max("ts").cast("timestamp_ntz").alias("timestamp"),
        F.count_if("ok").cast("int").alias("processed_pages"),
    )


def failed_pages(status: DataFrame) -> DataFrame:
    """Pages whose latest attempt failed, as rows: their number has no bound."""
    return latest_status(status).where("NOT ok").select("page_num")


def listed_failures(summary: DataFrame) -> DataFrame:
    """The same rows out of a summary file that lists the pages itself."""
    return summary.select(F.explode("failed_pages").alias("page_num"))


def write_checkpoint(status: DataFrame, total_rows: int, path: str) -> None:
    """Export of the run state as JSON: the summary, and the failed pages as lines beside it."""
    summary = summary_of(status, total_rows)
    summary.write.mode("overwrite").option("timestampNTZFormat", ISO_WRITE).json(path + "/summary")
    failed_pages(status).write.mode("overwrite").json(path + "/failed_pages")


def read_checkpoint(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Summary and failed pages of an export; a missing or broken part has no rows."""
    pages = T.StructType().add("page_num", T.IntegerType())
    return read_summary(spark, path + "/summary"), _read_json(spark, path + "/failed_pages", pages, multi_line=False)


def record_order(records: DataFrame) -> Column:
    """A number that puts the records of a page in order: the later attempt counts, of one attempt the one that succeeded,
    and of equal ones the row that was written last (``row``, where the records have it)."""
    row = F.col("row") if "row" in records.columns else F.lit(0)
    newest = (F.col("attempt").cast("long") * 2 + F.col("ok").cast("int")).cast("decimal(19,0)")
    return (newest * F.lit(str(2**63)).cast("decimal(19,0)") + row.cast("decimal(19,0)")).cast("decimal(38,0)")


def latest_records(records: DataFrame) -> DataFrame:
    """The one record of every page that counts. Only numbers are grouped; the records meet them by a semi join."""
    ordered = records.withColumn("_order", record_order(records))
    newest = ordered.groupBy("page_num").agg(F.max("_order").alias("_order"))
    return ordered.join(newest, ["page_num", "_order"], "left_semi").drop("_order")


def latest_status(status: DataFrame) -> DataFrame:
    """Latest outcome of every page, by :func:`record_order`.

    Keys and buffers are plain numbers, so this is a hash aggregation with a map-side part.
    """
    newest = record_order(status)
    return status.groupBy("page_num").agg(
        F.max("attempt").alias("attempt"),
        F.max_by("ok", newest).alias("ok"),
        F.max_by("n_rows", newest).alias("n_rows"),
        F.max("ts").alias("ts"),
    )
