"""Documents packed into sequences of a fixed length by hierarchical best fit.

Every task cuts and packs the pieces it reads (best fit, longest first). Bins that are nearly full are final; the
others become the items of the next round, where fewer groups pack them again, until one group is left. A bin is one
row that carries its pieces, at most ``capacity`` of them, so rounds move bins as a whole and nothing is joined. Each
round is written to the shared folder, so a lost executor never changes which pieces lie together.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.common import arrow_rows, new_dir, tidy, trimmed
from pagesift.llm.encoding import encoder_of

CAPACITY = 1024
END_ID = 2
SLACK = 8  # free places up to which a bin counts as full
GROUP = 20_000  # bins that one group of a later round packs
FLUSH = 100_000  # pieces that a task holds before it packs them
TEXTS = 2_000  # texts that a worker holds at once

MEMBER = pa.struct(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("offset", pa.int64())]
)
_MEMBER_SQL = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,crc:bigint,offset:bigint>"
BIN_SQL = f"sequence_id bigint, fill bigint, done boolean, members array<{_MEMBER_SQL}>"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, each into the fullest bin that can still take it."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by free places
    open_sizes = 0  # bit r: some bin has r free places
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = open_sizes >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            k = free[left].pop()
            if not free[left]:
                open_sizes &= ~(1 << left)
            bins[k].append(item)
            left -= size
        else:
            k, left = len(bins), capacity - size
            bins.append([item])
        free[left].append(k)
        open_sizes |= 1 << left
    return bins


def pieces_of(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document: the first takes what is left over, the others are full."""
    if n_ids <= capacity:
        return [(0, n_ids)]
    first = n_ids % capacity
    starts = ([0] if first else []) + list(range(first, n_ids, capacity))
    return list(zip(starts, [b - a for a, b in zip(starts, [*starts[1:], n_ids])]))


def _rows(bins: list[np.ndarray], columns: dict[str, np.ndarray], base: int, limit: int, last: bool) -> pa.RecordBatch:
    """Bins, given as member numbers, as rows; ``columns`` hold the members."""
    counts = np.array([len(b) for b in bins], np.int64)
    flat = np.concatenate(bins) if bins else np.zeros(0, np.int64)
    length = columns["length"][flat]
    ends = np.cumsum(counts)
    total = np.cumsum(length)
    before = total - length
    heads = ends - counts
    fill = np.add.reduceat(length, heads) if len(bins) else np.zeros(0, np.int64)
    offset = before - np.repeat(before[heads] if len(bins) else fill, counts)
    fields = [pa.array(columns[f.name][flat], f.type, mask=columns["null"][flat] if f.name == "doc_id" else None) for f in list(MEMBER)[:-1]]
    members = pa.StructArray.from_arrays([*fields, pa.array(offset, pa.int64())], fields=list(MEMBER))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), members)
    done = np.ones(len(bins), bool) if last else fill >= limit
    return pa.RecordBatch.from_arrays(
        [pa.array(base + np.arange(len(bins))), pa.array(fill), pa.array(done), lists],
        names=["sequence_id", "fill", "done", "members"],
    )


def _first_round(encoder: str, capacity: int, end_id: int, slack: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, made = encoder_of(encoder), 0
        base = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []

        def packed() -> pa.RecordBatch:
            nonlocal made
            table = np.array([(r[0] or 0, *r[1:]) for r in rows], np.int64).reshape(-1, 5)
            columns = {name: table[:, k] for k, name in enumerate(("doc_id", "piece", "start", "length", "crc"))}
            columns["null"] = np.array([r[0] is None for r in rows], bool)
            bins = [np.array(b) for b in best_fit(columns["length"], capacity)]
            out = _rows(bins, columns, base + made, capacity - slack, False)
            made += len(bins)
            rows.clear()
            return out

        end = np.array([end_id], np.uint32)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(k, TEXTS)
                texts = [t or "" for t in batch.column("_text").to_pylist()]
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), own.encode(texts)):
                    raw = np.concatenate([ids, end]).astype("<u4").tobytes()
                    for piece, (start, length) in enumerate(pieces_of(len(ids) + 1, capacity)):
                        rows.append((doc_id, piece, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                tidy()
                if len(rows) >= FLUSH:
                    yield packed()
        if rows:
            yield packed()

    return trimmed(run)


def _later_round(capacity: int, limit: int, base: int, last: bool) -> Callable:
    def run(key: tuple, bins: pa.Table) -> pa.Table:
        lists = bins.column("members").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten()
        columns = {}
        for k, f in enumerate(MEMBER):
            values = flat.field(k)
            if f.name == "doc_id":
                columns["null"] = np.asarray(values.is_null())
                values = values.fill_null(0)
            columns[f.name] = np.asarray(values)
        ends = np.cumsum(np.asarray(lists.value_lengths()))
        parts = np.split(np.arange(len(flat)), ends[:-1])
        # the same order of bins whatever order they arrive in
        ids, fill = np.asarray(bins.column("sequence_id")), np.asarray(bins.column("fill"))
        order = np.argsort(ids, kind="stable")
        groups = best_fit(fill[order], capacity)
        merged = [np.concatenate([parts[order[k]] for k in g]) for g in groups]
        start = base + (int(key[0].as_py()) << 32)
        return pa.Table.from_batches([_rows(merged, columns, start, limit, last)])

    return run


def packed_bins(documents: DataFrame, encoder: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK, group: int = GROUP, text: str = "text") -> DataFrame:
    """One row per sequence with its ``members`` in order; see ``packed``.

    A round halves nothing by itself: it runs while there is more than one group and while it saves at least one bin in
    a hundred, so bins that cannot be paired at all end the rounds instead of meeting in one task.
    """
    spark = documents.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = new_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(BIN_SQL).parquet(path)

    source = documents.select(F.col("doc_id").cast("long"), F.col(text).alias("_text"))
    with arrow_rows(spark, TEXTS):
        bins = written(source.mapInArrow(_first_round(encoder, capacity, end_id, slack), BIN_SQL), "bins")
    out, level, left = bins.where("done"), 0, bins.where("NOT done")
    waiting = left.count()
    while waiting:
        level += 1
        groups = max(1, -(-waiting // group))
        last = groups == 1
        pack = _later_round(capacity, capacity - slack, level << 56, last)
        key = F.pmod(F.xxhash64("sequence_id"), F.lit(groups)).alias("part")
        bins = written(left.groupBy(key).applyInArrow(pack, BIN_SQL), "bins")
        out, left = out.unionByName(bins.where("done")), bins.where("NOT done")
        before, waiting = waiting, 0 if last else left.count()
        if waiting > 0.99 * before:
            return out.unionByName(left)
    return out


def packed(documents: DataFrame, encoder: str, **options) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document.

    A document is its ids and an end id; a null or empty text is the end id alone. Only documents that are longer than
    a sequence are cut. Rows that repeat a ``doc_id``, or have none, are packed like any other row.
    """
    bins = packed_bins(documents, encoder, **options)
    pieces = bins.select("sequence_id", F.explode("members").alias("m"))
    return pieces.select(
        "m.doc_id", "m.piece", "m.start", "m.length", F.col("m.crc").alias("ids_crc32"), "sequence_id", "m.offset"
    )
