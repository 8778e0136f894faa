"""Page snapshots: tables or files of saved HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift import fixed_values as fv


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Give every core a share when a small input comes in fewer splits than there are cores.

    ``scan`` must be a plain file scan. Large inputs have far more splits than cores and are
    left as they are, so their HTML is never shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


# what a task reads of many small files
POOLED_BYTES = 32 << 20


def pool_scan(scan: DataFrame) -> DataFrame:
    """Give every task a fair share of very many small files.

    ``scan`` must be a plain file scan. Spark counts 4 MB for opening a file, so 32 files make a task however small they
    are, and starting a task takes longer than reading them. Scans of few or of large files are left as they are.
    """
    tasks = scan.rdd.getNumPartitions()
    size = scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    wanted = max(4 * scan.sparkSession.sparkContext.defaultParallelism, int(str(size)) // POOLED_BYTES)
    return scan.coalesce(wanted) if wanted < tasks else scan


def read_pages(spark: SparkSession, path: str, *columns: str, key: str = "page_id") -> DataFrame:
    """Snapshot table in parquet; only the named columns are read."""
    scan = spark.read.parquet(path)
    return spread_scan(scan.select(*columns) if columns else scan, key)


def read_html_files(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """Saved pages as files, one row per file: ``url`` is the file's path, ``charset`` what it was read as.

    The charset is named by the byte order mark or by a ``meta`` element among the first 1,024 bytes; without either it
    is UTF-8. Names that Spark cannot decode are read as windows-1252, which has a character for every byte. Bytes that
    are not UTF-8 become U+FFFD.
    """
    files = pool_scan(
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    )
    head = "decode(substring(content, 1, 1024), 'ISO-8859-1')"
    named = rf"nullif(lower(regexp_extract({head}, '(?i)<meta[^>]+charset\\s*=\\s*[\\x22\\x27]?\\s*([-_A-Za-z0-9]+)', 1)), '')"
    marked = files.withColumn("_head", F.hex(F.substring("content", 1, 3))).withColumn(
        "charset",
        F.expr(
            "CASE WHEN _head = 'EFBBBF' THEN 'utf-8' WHEN _head LIKE 'FEFF%' THEN 'utf-16be' WHEN _head LIKE 'FFFE%' THEN 'utf-16le'"
            f" ELSE CASE WHEN coalesce({named}, 'utf-8') IN ('utf-8', 'utf8', 'us-ascii', 'ascii', 'utf-16', 'utf-16be', 'utf-16le') THEN 'utf-8'"
            " ELSE 'windows-1252' END END"
        ),
    )
    # translating takes far longer than looking for something to translate, which few pages have
    latin = F.decode("content", "ISO-8859-1")
    windows = F.translate(latin, "".join(map(chr, fv.WINDOWS_1252)), "".join(fv.WINDOWS_1252.values()))
    latin = F.when(F.regexp_like(latin, F.lit(r"[\x80-\x9f]")), windows).otherwise(latin)
    text = (
        F.when(F.col("charset") == "utf-16be", F.decode(F.expr("substring(content, 3)"), "UTF-16BE"))
        .when(F.col("charset") == "utf-16le", F.decode(F.expr("substring(content, 3)"), "UTF-16LE"))
        .when(F.col("charset") == "windows-1252", latin)
        .otherwise(F.make_valid_utf8(F.expr("IF(_head = 'EFBBBF', substring(content, 4), content)").cast("string")))
    )
    return marked.select(
        F.col("path").alias("url"), F.col("modificationTime").alias("fetched_at"), text.alias("html"), "charset"
    )


def list_snapshots(files: DataFrame, page_pattern: str = r"(\d+)[^/\d]*$") -> DataFrame:
    """Saved list pages as the snapshots of a run: the page number is the last number of the file's path.

    Files without a number are left out; a file of white space is a page that was not loaded. Spark leaves out files of no
    bytes, so their pages count as not saved.
    """
    number = F.regexp_extract("url", page_pattern, 1)
    return files.select(
        number.try_cast("int").alias("page_num"),
        "html",
        F.regexp_like("html", F.lit(r"\S")).alias("success"),
        F.col("fetched_at").cast("timestamp").alias("fetched_at"),
    ).where(F.col("page_num").isNotNull())
