"""Helpers that several operators share: reading columns in workers, samples of distinct texts, rows that a join cannot meet,
and connected components."""

from __future__ import annotations

import ctypes
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.session import drop, new_dir, release, scratch, ship, stored

__all__ = [
    "arrow_rows", "components", "drop", "least_hashes", "met_and_others", "new_dir", "read_table", "release", "scratch", "ship", "stored", "strings",
    "tidy", "trimmed",
]


def tidy() -> None:
    """Give freed memory of a Python worker back to the machine; idle workers then hold little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it keeps what it keeps
        pass


def trimmed(run):
    """``run`` over batches, which gives back memory when it has ended: an idle worker then holds none of its arrays."""

    def whole(batches):
        yield from run(batches)
        tidy()

    return whole


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def strings(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null is read as empty."""
    return [t or "" for t in column.to_pylist()]


@contextmanager
def arrow_rows(spark, rows: int):
    """Arrow batches of at most ``rows`` rows for jobs that run inside; the caller's setting comes back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def least_hashes(rows: DataFrame, limit: int) -> dict[str, int]:
    """Of (l, h), a group and the hash of a text: the ``limit``-th smallest distinct hash of every group, or its largest.

    So many distinct texts of a group have a hash up to that, however often they occur. The driver reads a little more
    than twice ``limit`` hashes of a group: those in a share of the range of hashes that the distinct ones fill evenly.
    """
    distinct = stored(rows.select("l", "h").distinct(), "text-hashes")
    numbers = {r["l"]: r["n"] for r in distinct.groupBy("l").agg(F.count("h").alias("n")).collect()}
    found: dict[str, list[int]] = {}
    times = 2
    while any(len(found.get(name, ())) < min(limit, n) for name, n in numbers.items()):
        bounds = {name: min(2**63 - 1, -(2**63) + 2**64 * (times * limit + 64) // n) for name, n in numbers.items()}
        of_group = F.create_map(*(F.lit(v) for pair in bounds.items() for v in pair))
        found = {}
        for r in distinct.where(F.col("h") <= of_group[F.col("l")]).collect():
            found.setdefault(r["l"], []).append(r["h"])
        times *= 2
    return {name: sorted(hashes)[:limit][-1] for name, hashes in found.items()}


MET_BITS = 24


def met_and_others(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``keys`` may be in ``wanted``, and those whose are not: these need no join, and so no shuffle.

    A bitmap of 2 ** 24 bits, up to 262,144 rows of 64 of them, is broadcast whatever the number of keys. A full one
    only means that more rows take the join; the caller's join tells exactly. Keys are not null.
    """
    slot = F.shiftrightunsigned(F.xxhash64(*keys), 64 - MET_BITS)
    bit = F.expr("shiftleft(1L, cast(_slot & 63 AS INT))")
    cells = wanted.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    near = rows.withColumn("_slot", slot).withColumn("_word", F.shiftright("_slot", 6)).join(F.broadcast(cells), "_word", "left")
    hit = F.coalesce(F.col("_bits"), F.lit(0).cast("long")).bitwiseAND(bit) != 0
    return tuple(near.where(side).select(*rows.columns) for side in (hit, ~hit))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Large-star and small-star rounds: every node first hands its larger neighbours, then its smaller ones, to the
    smallest node it sees, until each component is a star around its smallest node. Minima are taken map-side, so a
    node with very many neighbours sends one row per task. Each round is written to the shared folder, which cuts the
    lineage. Nodes are longs; null ends and loops are left out.
    """
    edges = stored(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    while not _is_stars(edges):
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links"
        )
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(
            F.inline(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
        )
        edges = stored(small.where("u <> v").distinct(), "links")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has either one smaller neighbour or only larger ones."""
    ends = edges.select(
        F.inline(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                         F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    )
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()
