"""Joins and groups in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds at least one row in HOT_SHARE. Keys are looked for in a sample of SAMPLED rows, of which a hot
# key has some two hundred, and taken from half that share on: at most twice HOT_SHARE keys, whatever the data looks
# like. The sample decides which rows are spread over tasks, never which rows there are.
HOT_SHARE = 1000
SAMPLED = 200_000
SALTS = 64


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE, sampled: int = SAMPLED) -> DataFrame:
    """The at most ``2 * share`` keys that hold much of the rows (and more than one row of a sample)."""
    total = rows.count()
    chosen = rows.select(key).sample(min(1.0, sampled / max(total, 1)), seed=1)
    size = min(total, sampled)
    return chosen.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & (F.col("_n") * 2 * share >= size)).select(key)


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Inner join in which the rows of a hot key are spread over ``salts`` tasks.

    ``lookup`` has one row per key; only its hot rows are repeated. ``rows`` carry columns that
    tell them apart (page and position), from which the salt is taken, and are read twice, so
    hand in a stored table.
    """
    hot = F.broadcast(hot_keys(rows, key).withColumn("_hot", F.lit(True)))
    other = [c for c in rows.columns if c != key]
    salted = rows.join(hot, key, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*other), F.lit(salts)).cast("int")).otherwise(0)
    )
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = lookup.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return salted.drop("_hot").join(spread.drop("_hot"), [key, "_salt"], "inner").drop("_salt")
