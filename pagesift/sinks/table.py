"""Publishing a result under a table name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish_table(rows: DataFrame, name: str, path: str) -> str:
    """Replace what ``name`` shows.

    The rows are written to a folder of their own first; readers of ``name`` switch from the
    old rows to the complete new ones in one step and never meet a half-written table.
    """
    spark = rows.sparkSession
    rows.write.mode("errorifexists").parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    return name


def publish_managed_table(rows: DataFrame, name: str) -> str:
    """Replace a catalog table by the rows."""
    rows.write.mode("overwrite").saveAsTable(name)
    return name


def publish_jdbc(rows: DataFrame, url: str, name: str, max_connections: int = 16, **properties: str) -> str:
    """Replace a database table by the rows, with a bounded number of connections.

    Fewer tasks than connections are left as they are; more are merged without a shuffle.
    """
    (
        rows.write.mode("overwrite")
        .option("numPartitions", max_connections)
        .option("truncate", True)
        .option("batchsize", 10_000)
        .jdbc(url, name, properties=properties)
    )
    return name
