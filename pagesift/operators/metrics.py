"""Run totals, rates, retry yield, column widths and completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagesift import fixed_values as fv


def rows_per_page(rows: DataFrame) -> DataFrame:
    return rows.groupBy("page_num").agg(F.count(F.lit(1)).alias("n_rows"))


def _elapsed_seconds(time: Column) -> Column:
    return (F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))) / F.lit(1_000_000)


def run_totals(status: DataFrame, time: str = "ts") -> DataFrame:
    """One row over page outcomes: totals, progress and throughput."""
    totals = status.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("pages_planned"),
        F.count_if("ok").alias("pages_ok"),
        F.count_if(~F.col("ok")).alias("pages_failed"),
        F.coalesce(_elapsed_seconds(F.col(time).cast("timestamp")), F.lit(0.0)).alias("elapsed_seconds"),
    )
    rate = F.when(F.col("elapsed_seconds") > 0, F.col("total_rows") / F.col("elapsed_seconds")).otherwise(0.0)
    percent = F.when(F.col("pages_planned") > 0, F.col("pages_ok") * 100.0 / F.col("pages_planned")).otherwise(0.0)
    return totals.select(
        "*",
        percent.cast("double").alias("progress_percent"),
        (F.col("elapsed_seconds") / 60).alias("elapsed_minutes"),
        rate.alias("rows_per_second"),
    )


def observed(results: DataFrame, watch: Observation) -> DataFrame:
    """Count pages and rows while they are written, without another pass over them."""
    return results.observe(
        watch,
        F.count(F.lit(1)).alias("pages"),
        F.count_if("ok").alias("pages_ok"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("rows"),
    )


def retry_yield(first_failed: DataFrame, retried: DataFrame) -> DataFrame:
    """Pages tried again, recovered and still open."""
    outcome = first_failed.select("page_num").join(
        retried.where("ok").select("page_num", F.lit(True).alias("_ok")), "page_num", "left"
    )
    return outcome.agg(
        F.count(F.lit(1)).alias("retried"),
        F.count_if("_ok").alias("recovered"),
        F.count_if(F.col("_ok").isNull()).alias("remaining"),
    )


def column_widths(rows: DataFrame) -> DataFrame:
    """Display width of every column: longest cell or header plus 2, at most 100."""
    widths = rows.agg(*[F.max(F.length(F.coalesce(F.col(c), F.lit(fv.MISSING)))).alias(c) for c in rows.columns])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.least(F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(len(c))) + 2, F.lit(fv.MAX_COLUMN_WIDTH)).alias(
                "width"
            ),
        )
        for c in rows.columns
    ]
    return widths.select(F.inline(F.array(*cells)))


def completeness(rows: DataFrame) -> DataFrame:
    """Rows, missing cells and their share for every column, in one pass with no unpivot of the rows."""
    missing = rows.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull() | (F.col(c) == fv.MISSING)).alias(c) for c in rows.columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(c).alias("n_missing"),
            F.try_divide(F.col(c).cast("double"), F.col("_rows").cast("double")).alias("missing_share"),
        )
        for c in rows.columns
    ]
    return missing.select(F.inline(F.array(*cells)))
