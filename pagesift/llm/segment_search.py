"""Exact top-k by inner product with segment statistics, coarse to fine.

A vector is cut into segments; of each, the mean and the deviation (root of the summed squares around the mean) are
kept. For two vectors the squared distance is at least the sum over segments of length * (difference of means) ** 2 +
(difference of deviations) ** 2, so the score, (|q|^2 + |c|^2 - distance^2) / 2, is at most half of what is left. Bounds
with few segments rule out most candidates, bounds with more segments the next ones, and scores are computed for the
survivors.

Queries and candidates are dealt into blocks of bounded size. A task holds one block of each, so neither side is ever
broadcast or whole in one place; of each pair of blocks only k rows a query go on.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows without id, take no part;
vectors of different lengths are not compared; ids that repeat are rows of their own, and only the query's own row is
left out. A query with fewer than k candidates gets all of them. Scores beyond a long are ranked by their exact value and
shown as the largest or smallest long; components that are beyond the range of a double once they are scaled count as the
end of that range.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesift.llm.common import ship, stored
from pagesift.llm.vectors import finite, matrix, pack, unpack

SCALE = 1024
QUERY_BLOCK = 1_024
BLOCK = 8_192
SEGMENTS = (4, 16)
_EXACT = 2.0**52  # sums below this are whole numbers in double precision
_LIMIT = 2**63 - 1


def statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each segment, times the root of its length where they enter the bound."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)[:-1]
    sizes = np.diff(np.append(edges, x.shape[1]))
    sums = np.add.reduceat(x, edges, axis=1)
    squares = np.add.reduceat(x * x, edges, axis=1)
    return sums / np.sqrt(sizes), np.sqrt(np.maximum(squares - sums * sums / sizes, 0.0))


def upper_bounds(q: tuple[np.ndarray, np.ndarray], c: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Largest possible score of every query with every candidate: by the distance bound, written as products."""
    return q[0] @ c[0].T + q[1] @ c[1].T


def best(q: np.ndarray, c: np.ndarray, q_row: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, k: int) -> list[tuple[int, list[int], list[int]]]:
    """For each query its number, and places and exact scores of the best ``k`` candidates, ties to the smaller id.

    Rows whose components are so large that a sum of products may not be exact in double precision are set apart: only
    pairs with such a row are computed in whole numbers of any size.
    """
    if not len(q) or not len(c):
        return []
    largest = math.sqrt(_EXACT / q.shape[1])
    q_large, c_large = (np.abs(x).max(axis=1) >= largest for x in (q, c))
    plain, rest = np.flatnonzero(~c_large), np.flatnonzero(c_large)
    whole: dict[int, list[int]] = {}

    def scored(i: int, places: np.ndarray) -> list[tuple[int, int, int]]:
        mine = _whole(q[i])
        for j in places.tolist():
            if j not in whole:
                whole[j] = _whole(c[j])
        return [(-sum(a * b for a, b in zip(mine, whole[j])), int(c_id[j]), j) for j in places.tolist() if c_row[j] != q_row[i]]

    found: dict[int, list[tuple[int, int, int]]] = {i: scored(i, np.arange(len(c))) for i in np.flatnonzero(q_large).tolist()}
    usual = np.flatnonzero(~q_large)
    for i, places, scores in _best_of_plain(q[usual], c[plain], q_row[usual], c_row[plain], c_id[plain], k):
        place = plain[places]
        pairs = list(zip((-scores).tolist(), c_id[place].tolist(), place.tolist()))
        found[int(usual[i])] = pairs + scored(int(usual[i]), rest)
    for i in usual.tolist() if not len(plain) else ():
        found[i] = scored(i, rest)
    out = []
    for i in sorted(found):
        first = heapq.nsmallest(k, found[i])
        out.append((i, [j for _, _, j in first], [-s for s, _, _ in first]))
    return out


def _whole(row: np.ndarray) -> list[int]:
    return [int(v) for v in row.tolist()]


def _best_of_plain(q, c, q_row, c_row, c_id, k):
    """The same by bounds, coarse to fine, for rows whose products are exact in double precision."""
    if not len(q) or not len(c):
        return
    bounds = upper_bounds(statistics(q, SEGMENTS[0]), statistics(c, SEGMENTS[0]))
    fine_q, fine_c = statistics(q, SEGMENTS[1]), statistics(c, SEGMENTS[1])
    margin = 1e-9 * (1.0 + np.abs(bounds).max())
    seeds = min(4 * k + 1, len(c))
    for i in range(len(q)):
        own = c_row == q_row[i]
        first = np.argpartition(-bounds[i], seeds - 1)[:seeds]
        first = first[~own[first]]
        scores = c[first] @ q[i]
        least = np.sort(scores)[-k] if len(scores) >= k else -np.inf
        left = np.flatnonzero((bounds[i] >= least - margin) & ~own)
        finer = fine_c[0][left] @ fine_q[0][i] + fine_c[1][left] @ fine_q[1][i]
        left = left[finer >= least - margin]
        scores = c[left] @ q[i]
        if len(left) > k:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            left, scores = left[scores >= cut], scores[scores >= cut]
        order = np.lexsort((c_id[left], -scores))[:k]
        yield i, left[order], scores[order].astype(np.int64)


def order_key(score: int) -> bytes | None:
    """Bytes in the order of the scores, for scores beyond a long; null for all others, which a long holds."""
    if -_LIMIT < score < _LIMIT:
        return None
    data = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    data = len(data).to_bytes(4, "big") + data
    return b"\x01" + data if score > 0 else b"\x00" + bytes(255 - b for b in data)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``dim, block, payload``: rows of one vector length, dealt by hash into blocks of about ``size``."""
    counts = {r.dim: r["count"] for r in rows.groupBy("dim").count().collect()}
    if not counts:
        return rows.select("dim", F.lit(0).alias("block"), F.lit(b"").alias("payload")).where("false")
    number = F.create_map(*(F.lit(x) for d, n in counts.items() for x in (d, -(-n // size))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), number[F.col("dim")]).cast("int"))

    def packed(key: tuple, group: pa.Table) -> pa.Table:
        x = np.floor(matrix(group.column("vector")) * SCALE)
        x = np.where(np.isfinite(x), x, np.copysign(np.finfo(np.float64).max, x))
        payload = pack(x=x, id=np.asarray(group.column("id")), row=np.asarray(group.column("row")))
        return pa.table({"dim": [key[0].as_py()], "block": [key[1].as_py()], "payload": [payload]}, schema=_PACKED)

    return dealt.groupBy("dim", "block").applyInArrow(packed, "dim int, block int, payload binary")


_PACKED = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
_FOUND = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.int64()), ("key", pa.binary())])


def _search(k: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        sides = {s: unpack(p) for s, p in zip(group.column("side").to_pylist(), group.column("payload").to_pylist())}
        q, c = sides["q"], sides["c"]
        found = best(q["x"], c["x"], q["row"], c["row"], c["id"], k)
        sizes = [len(p) for _, p, _ in found]
        who = np.repeat([i for i, _, _ in found], sizes).astype(int)
        place = np.array([j for _, p, _ in found for j in p], int)
        exact = [s for _, _, scores in found for s in scores]
        score = np.array([max(-_LIMIT, min(_LIMIT, s)) for s in exact], np.int64)
        return pa.table([q["id"][who], q["row"][who], c["id"][place], c["row"][place], score, pa.array(map(order_key, exact), pa.binary())], schema=_FOUND)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", query_block: int = QUERY_BLOCK, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(finite(vector) & F.col(id).isNotNull()).select(
        F.col(id).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.size(vector).alias("dim"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    )
    rows = stored(rows, "vectors")
    candidates = stored(_blocks(rows, block), "candidate-blocks")
    queries = stored(_blocks(rows.where("query"), query_block), "query-blocks")
    # each block of queries meets each block of candidates of its length: pairs of numbers first, then their rows
    numbers = queries.select("dim", F.col("block").alias("qb")).join(candidates.select("dim", F.col("block").alias("cb")), "dim")
    sides = numbers.join(queries.withColumnRenamed("block", "qb"), ["dim", "qb"]).select("dim", "qb", "cb", F.lit("q").alias("side"), "payload")
    sides = sides.unionByName(
        numbers.join(candidates.withColumnRenamed("block", "cb"), ["dim", "cb"]).select("dim", "qb", "cb", F.lit("c").alias("side"), "payload")
    )
    found = sides.groupBy("dim", "qb", "cb").applyInArrow(_search(k), "query_id long, query_row long, vec_id long, row long, score long, key binary")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.desc("key"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
