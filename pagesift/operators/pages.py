"""Page outcomes, pages still to do, retries and the early stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# page numbers are INT, so there are at most 32,768 blocks
BLOCK_BITS = 16
# pages to a bitmap: the size that bitmap_construct_agg has
BITMAP_BITS = 15
BITMAP_PAGES = 1 << BITMAP_BITS
NO_ROWS = "no rows"


def block_of(page_num: Column) -> Column:
    return F.shiftright(page_num, BLOCK_BITS)


def with_outcome(results: DataFrame) -> DataFrame:
    """A page is ok when it was read and gave at least one row; all others count as failed."""
    rows = F.coalesce(F.size("cards"), F.lit(0))
    read = F.coalesce(F.col("success"), F.lit(False)) & F.col("parse_error").isNull()
    return results.withColumn("n_rows", F.when(read, rows).otherwise(0)).withColumn(
        "ok", read & (F.col("n_rows") > 0)
    )


def until_empty_page(results: DataFrame) -> DataFrame:
    """Pages before the first one that was read and held nothing; failures do not stop the run.

    A page that was loaded but could not be parsed is a failure, so it does not stop a run either. ``results`` has one
    row per page, its latest attempt.
    """
    read = F.col("success")
    if "parse_error" in results.columns:
        read = read & F.col("parse_error").isNull()
    if "error" in results.columns:
        read = read & (F.col("error") == NO_ROWS)
    return results.where(F.col("page_num") < first_empty(results.where(read)).select("stop").scalar())


def first_empty(read: DataFrame) -> DataFrame:
    """One row with ``stop``, the first of the pages that were read which held nothing."""
    return read.where("n_rows = 0").agg(F.coalesce(F.min("page_num"), F.lit(2**31 - 1)).alias("stop"))


def pending_pages(plan: DataFrame, status: DataFrame) -> DataFrame:
    """Planned pages that no attempt has completed; ``status`` has one row per page."""
    done = status.where("ok").select("page_num")
    return plan.join(done, "page_num", "left_anti")


def page_bitmaps(numbers: DataFrame) -> DataFrame:
    """``_bucket, _bits``: the pages of ``numbers`` as one bitmap of 4 KB per 32,768 page numbers.

    Page numbers are INT, so there are at most 65,536 bitmaps (256 MB if every one of them is in use; 1.5 MB for ten
    million pages): a bound that does not depend on the pages' size.
    """
    number = F.col("page_num")
    bits = F.bitmap_construct_agg(number.bitwiseAND(BITMAP_PAGES - 1)).alias("_bits")
    return numbers.where(number.isNotNull()).groupBy(F.shiftright(number, BITMAP_BITS).alias("_bucket")).agg(bits)


def in_bitmap(bits: str, page_num: str) -> Column:
    """Whether the bit of a page is set in the bitmap of its bucket."""
    place = f"({page_num} & {BITMAP_PAGES - 1})"
    byte = f"CAST(conv(hex(substring({bits}, {place} div 8 + 1, 1)), 16, 10) AS INT)"
    return F.expr(f"getbit({byte}, {place} % 8) = 1")


def without_done(snapshots: DataFrame, status: DataFrame) -> DataFrame:
    """Snapshots of pages that are not done yet. The HTML stays where it is, however scattered these pages are.

    What is sent to it are the done pages as bitmaps.
    """
    done = F.broadcast(page_bitmaps(status.where("ok").select("page_num")))
    joined = snapshots.withColumn("_bucket", F.shiftright("page_num", BITMAP_BITS)).join(done, "_bucket", "left")
    is_open = F.col("_bits").isNull() | ~in_bitmap("_bits", "page_num")
    return joined.where(is_open).select(*snapshots.columns)


def still_failed(failed: DataFrame, retried: DataFrame) -> DataFrame:
    """Failed pages without the ones a retry brought in."""
    return failed.join(retried.where("ok").select("page_num"), "page_num", "left_anti")


def with_retried(rows: DataFrame, retried_rows: DataFrame) -> DataFrame:
    """Rows of the first pass and of the retry, nothing removed."""
    return rows.unionByName(retried_rows)


def site_probe(pages: DataFrame, nodes: str = "nodes") -> DataFrame:
    """Cards on each page and the flag a probe of it returns: -1 to go on, 0 to stay away."""
    cards = F.coalesce(F.size(F.filter(F.col(nodes), lambda n: n["tag"] == "article")), F.lit(0))
    return pages.withColumn("n_cards", cards).withColumn("probe", F.when(F.col("n_cards") > 0, -1).otherwise(0))
