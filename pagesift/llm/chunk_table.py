"""SentencePiece ids of whole texts through a table of distinct marked words.

1. Tasks cut their documents into blocks of about ``BLOCK`` characters and number the distinct marked words of a block.
   A block is written once: one row with its words, and one row per document with the numbers of its words in order.
   The table is bucketed by block, so that these rows, the larger part by far, never go through a shuffle.
2. The words of all blocks meet by their hash. Each distinct word is segmented once, for all blocks that have it.
3. The ids come back to their block, where they take the places of the numbers.

What is shuffled is a block's distinct words and their ids, packed by block and bucket of words, never a row per word of a
text. A word that every text has is one entry per block, however often it occurs, so hot words need no salt. A block
and a bucket of words are bounded; a single text longer than a block is a block of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.bpe import Encoder
from pagesift.llm.common import new_dir, ship, strings, tidy
from pagesift.llm.pieces import Pieces, join_ids, marked_words, piece_arrays

BLOCK = 12_000_000  # characters after which a block ends
BUCKET = 1_000_000  # entries of block dictionaries that meet in one bucket of words, on average
_IDS = pa.list_(pa.field("element", pa.int32(), False))
_OPENED: dict[str, Pieces] = {}


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2**32 in little room: their bytes plane by plane, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> tuple[bytes, bytes]:
    return pack_numbers(np.fromiter(map(len, words), np.int64, len(words))), zstandard.compress(b"".join(words), 3)


def _unpack_words(lengths: bytes, data: bytes) -> list[bytes]:
    ends = np.cumsum(unpack_numbers(lengths)).tolist()
    raw = zstandard.decompress(data)
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def bucketed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``rows`` as a table in the shared folder, bucketed by ``key``; groups by that key then start at its files."""
    spark = rows.sparkSession
    table = f"pagesift_{name}_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, key).option("path", new_dir(spark, name)).option("compression", "none").saveAsTable(table)
    return spark.table(table)


def _numbered(documents: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The table of step 1: ``block, row, codes`` per document, ``block, n, lengths, words`` per dictionary."""
    row = T.StructType([documents.schema[c] for c in keep])
    schema = T.StructType().add("block", "long").add("row", row).add("codes", "binary")
    schema.add("n", "long").add("lengths", "binary").add("words", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        held: list[pa.Array] = []
        texts: list[str] = []
        size = number = 0

        def block() -> Iterator[pa.RecordBatch]:
            data, starts, lengths, owner = marked_words(texts)
            kind, words = np.zeros(0, np.int64), []
            if len(starts):
                sample, kind = Encoder.distinct(data, starts, lengths)
                raw = data.tobytes()
                words = [raw[a : a + n] for a, n in zip(starts[sample].tolist(), lengths[sample].tolist())]
                # frequent words get small numbers, which pack well; within a class of frequency the hash decides, so
                # that the words of a bucket lie in few runs
                often = np.bincount(kind, minlength=len(words))
                order = np.lexsort((_hashes(words), -(np.log2(often) // 2)))
                words = [words[k] for k in order.tolist()]
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                kind = place[kind]
            per_text = np.split(kind, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])
            rows, n = pa.concat_arrays(held), len(texts)
            none = pa.nulls(1, rows.type)
            packed = _pack_words(words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first + number] * (n + 1), pa.int64()),
                    pa.concat_arrays([none, rows]),
                    pa.array([None, *map(pack_numbers, per_text)], pa.binary()),
                    pa.array([len(words)] + [None] * n, pa.int64()),
                    pa.array([packed[0]] + [None] * n, pa.binary()),
                    pa.array([packed[1]] + [None] * n, pa.binary()),
                ],
                names=schema.names,
            )

        for batch in batches:
            begin = 0
            for k, t in enumerate(strings(batch.column("text"))):
                texts.append(t)
                size += len(t) + 1
                if size >= BLOCK:
                    held.append(batch.column("row").slice(begin, k + 1 - begin))
                    yield from block()
                    held, texts, size, number, begin = [], [], 0, number + 1, k + 1
                    tidy()
            if begin < batch.num_rows:
                held.append(batch.column("row").slice(begin))
        if texts:
            yield from block()

    packed = documents.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    return bucketed(packed.mapInArrow(run, schema), "block", "blocks")


def _opened(name: str, arrays) -> Pieces:
    if name not in _OPENED:
        _OPENED.clear()
        _OPENED[name] = Pieces(arrays.value)
    return _OPENED[name]


def _segmented(dictionaries: DataFrame, model: tuple) -> DataFrame:
    """``block, first, counts, ids``: the ids of a block's words from number ``first`` on; each word is segmented once."""
    spark = dictionaries.sparkSession
    entries = dictionaries.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(1, -(-entries // BUCKET))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, words in zip(*(batch.column(c).to_pylist() for c in ("block", "lengths", "words"))):
                words = _unpack_words(lengths, words)
                bucket = (_hashes(words) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)
                starts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
                ends = [*starts[1:].tolist(), len(words)]
                packed = [_pack_words(words[a:b]) for a, b in zip(starts.tolist(), ends)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket[starts].astype(np.int64)),
                        pa.array([block] * len(starts), pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array([p[0] for p in packed], pa.binary()),
                        pa.array([p[1] for p in packed], pa.binary()),
                    ],
                    names=["bucket", "block", "first", "lengths", "words"],
                )

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _opened(*model)
        now, number, pool, ends = None, {}, [], []
        flat = np.zeros(0, np.int32)
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "block", "first", "lengths", "words"))
            for bucket, block, first, lengths, words in zip(*columns):
                if bucket != now:  # the rows come sorted by bucket
                    now, number, flat, ends = bucket, {}, np.zeros(0, np.int32), np.zeros(0, np.int64)
                words = _unpack_words(lengths, words)
                new = [w for w in words if w not in number]
                if new:
                    ids, counts = own.segment(new)
                    number.update(zip(new, range(len(number), len(number) + len(new))))
                    ends = np.concatenate([ends, len(flat) + np.cumsum(counts)])
                    flat = np.concatenate([flat, ids])
                code = np.fromiter((number[w] for w in words), np.int64, len(words))
                size = np.diff(ends, prepend=0)[code]
                out.append((block, first, pack_numbers(size), pack_numbers(join_ids(flat, ends, code, np.array([len(code)]))[0])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["block", "first", "counts", "ids"],
            )
            tidy()

    dealt = dictionaries.select("block", "lengths", "words").mapInArrow(
        deal, "bucket long, block long, first long, lengths binary, words binary"
    )
    met = dealt.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(segment, "block long, first long, counts binary, ids binary")


def open_model(spark: SparkSession, model: str) -> tuple:
    """The arrays of a model file as a broadcast, with a name of their own. Their size is bounded by the vocabulary."""
    ship(spark)
    return uuid.uuid4().hex, spark.sparkContext.broadcast(piece_arrays(model))


def with_ids(
    documents: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), end_id: bool = True, decoded: bool = False
) -> DataFrame:
    """``keep`` columns, ``ids`` of every whole text (with the end id behind them) and, on request, the text ``decoded``.

    A null text counts as empty and has no ids but the end id. Rows may repeat, also with equal keys: every row gives one
    row. An empty table gives none. Columns that are not in ``keep`` do not matter, whatever their names; kept columns
    named ``ids`` or ``decoded`` give way to the results. Very long texts are encoded as one.
    """
    spark = documents.sparkSession
    opened = open_model(spark, model)
    kept = [c for c in keep if c not in ("ids", "decoded")]
    table = _numbered(documents, text, kept)
    codes = table.where("n IS NULL").select("block", "row", "codes")
    words = _segmented(table.where("n IS NOT NULL"), opened)
    row_type = codes.schema["row"].dataType
    schema = T.StructType(list(row_type.fields)).add("ids", T.ArrayType(T.IntegerType(), False))
    if decoded:
        schema.add("decoded", T.StringType())

    def join(batches: Iterator[pa.RecordBatch], pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _opened(*opened)
        parts = sorted((f, c, i) for p in pieces for f, c, i in zip(*(p.column(k).to_pylist() for k in ("first", "counts", "ids"))))
        size = np.concatenate([unpack_numbers(c) for _, c, _ in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        pool = np.concatenate([unpack_numbers(i) for _, _, i in parts] or [np.zeros(0, np.int64)]).astype(np.int32)
        ends = np.cumsum(size)
        for whole in batches:
            for k in range(0, whole.num_rows, 1_000):
                batch = whole.slice(k, 1_000)
                numbers = [unpack_numbers(c) for c in batch.column("codes").to_pylist()]
                lengths = np.fromiter(map(len, numbers), np.int64, len(numbers))
                ids = join_ids(pool, ends, np.concatenate(numbers).astype(np.int64), lengths)
                if end_id:
                    ids = [np.append(x, np.int32(own.end_id)) for x in ids]
                bounds = np.cumsum([0, *map(len, ids)])
                columns = [batch.column("row").field(c) for c in kept]
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)), type=_IDS))
                if decoded:
                    columns.append(pa.array(map(own.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        tidy()

    return codes.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_by_batches(join), schema)


def _by_batches(run):
    """``run`` over batches as a function of two Arrow tables."""

    def tables(left: pa.Table, right: pa.Table) -> pa.Table:
        out = list(run(iter(left.to_batches()), iter(right.to_batches())))
        return pa.Table.from_batches(out)

    return tables


def with_text(encoded: DataFrame, model: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and the ``decoded`` text of an array of ids; null ids give a null text."""
    opened = open_model(encoded.sparkSession, model)
    kept = [c for c in keep if c != "decoded"]
    schema = T.StructType([encoded.schema[c] for c in kept]).add("decoded", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _opened(*opened)
        for batch in batches:
            texts = [None if x is None else own.decode(np.asarray(x, np.int64)) for x in batch.column("ids").to_pylist()]
            columns = [batch.column("row").field(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(F.struct(*kept).alias("row"), F.col(ids).alias("ids")).mapInArrow(run, schema)
