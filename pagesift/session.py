"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_WORK_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCRATCH: dict[str, str] = {}

# A page is one row of up to tens of kilobytes, so Arrow batches are cut by rows well below the
# default of 10,000. Pages cost far more to parse than to read, so a shuffle in front of the
# parser keeps its tasks even where they look small. Listing a folder takes less than starting a task, so that folders
# are not listed by a task each.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def build_session(app_name: str = "pagesift", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    The workers need it for the parsing stage, wherever the driver was started and whatever is
    installed on the executors. Spark serves the archive from the driver.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="pagesift-code-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see: ``spark.checkpoint.dir`` of the session.

    A local session without that setting gets a temporary folder; on a cluster the setting is
    required, because a folder of one machine would not survive the loss of that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _LOCAL_WORK_DIR:
        _LOCAL_WORK_DIR[context.applicationId] = tempfile.mkdtemp(prefix="pagesift-")
    return _LOCAL_WORK_DIR[context.applicationId]


def new_dir(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, so that no run meets another run's files."""
    folder = _SCRATCH.get(spark.sparkContext.applicationId) or shared_dir(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, name: str):
    """Paths that are made inside lie in one folder, which is handed out; ``drop`` it when nothing reads it any more."""
    app = spark.sparkContext.applicationId
    before, folder = _SCRATCH.get(app), new_dir(spark, name)
    _SCRATCH[app] = folder
    try:
        yield folder
    finally:
        if before:
            _SCRATCH[app] = before
        else:
            _SCRATCH.pop(app)


def drop(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder with the tables in it, and what Spark holds for plans that are gone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody refers to any more; it looks for them after a collection."""
    gc.collect()
    spark._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later plans start at the files."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
