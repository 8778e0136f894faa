"""Alignment of the tokens of two tokenizers over the same bytes.

Every token points to the token that reaches farthest to the right among those that share a byte with it; successors are
doubled on whole arrays until each token knows the terminal token of its group, the one behind which both tokenizers cut.
Pairs of tokens that share a byte are links. Along a text the links form a path: from one to the next the first tokenizer
moves on, the second, or both, and both only where a group ends. So a document is kept as the numbers of its links in its
block and one step for each, and ids, groups and counts come out of these again.

How many documents hold a pair of ids is counted from one entry per block and pair, added up by Spark, and brought back to
the block. The table is bucketed by block, so the documents' rows go through no shuffle; a pair that every text has is one
entry per block. Only the highest count per id of the first tokenizer is broadcast: at most one row per id of its
vocabulary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm import bpe
from pagesift.llm.bpe import _ranges
from pagesift.llm.chunk_table import bucketed, pack_numbers, unpack_numbers
from pagesift.llm.common import ship, stored, strings, tidy
from pagesift.llm.pieces import Pieces, piece_arrays

BLOCK = 3_000_000  # characters after which a block ends
FIRST, SECOND, BOTH = 0, 1, 2  # which tokenizer moves on at a link
_OPENED: dict[str, tuple] = {}


class _Side:
    """Ids of texts by one tokenizer and the number of bytes of each id's token."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))

    def ids(self, texts: list[str], raw: list[bytes]) -> list[np.ndarray | None]:
        """Ids of the texts; None where the tokens' bytes are not the text's."""
        found = self.encode(texts)
        spelt = (b"".join(map(self.pieces.__getitem__, x.tolist())) for x in found)
        return [x.astype(np.int64) if s == r else None for x, s, r in zip(found, spelt, raw)]


def _sides(name: str, arrays) -> tuple[_Side, _Side]:
    if name not in _OPENED:
        _OPENED.clear()
        first, second = arrays.value
        plain = bpe.Encoder(first)
        plain.special, plain.special_any = {}, None  # special tokens' strings are ordinary text
        pieces = Pieces(second)
        _OPENED[name] = (
            _Side(lambda texts: list(plain.encode([" " + t for t in texts])), plain.pieces),
            _Side(pieces.encode, pieces.pieces),
        )
    return _OPENED[name]


def group_labels(first_ends: np.ndarray, second_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token of every token, as its number in the first tokenizer, by pointer jumping.

    The ends are byte offsets behind the tokens; both end at the same offset at last. A token points to the one of the
    other tokenizer that holds its last byte, since that one reaches farthest right; where both end there, the first
    tokenizer's token is terminal and points to itself.
    """
    n = len(first_ends)
    over = np.searchsorted(second_ends, first_ends, "left")
    succ = np.concatenate([
        np.where(second_ends[np.minimum(over, len(second_ends) - 1)] == first_ends, np.arange(n), n + over),
        np.searchsorted(first_ends, second_ends, "left"),
    ])
    while True:
        farther = succ[succ]
        if np.array_equal(farther, succ):
            return succ[:n], succ[n:]
        succ = farther


def links(first_sizes: np.ndarray, second_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of both sides of every link, in order of the text, and the step to each link."""
    if not len(first_sizes):
        none = np.zeros(0, np.int64)
        return none, none, none
    first_ends, second_ends = np.cumsum(first_sizes), np.cumsum(second_sizes)
    low = np.searchsorted(second_ends, first_ends - first_sizes, "right")
    size = np.searchsorted(second_ends, first_ends, "left") - low + 1
    a = np.repeat(np.arange(len(first_ends)), size)
    b = np.repeat(low, size) + _ranges(size)
    label = group_labels(first_ends, second_ends)[0][a]
    new_group = np.concatenate([[True], label[1:] != label[:-1]])
    same_a = np.concatenate([[False], a[1:] == a[:-1]])
    return a, b, np.where(new_group, BOTH, np.where(same_a, SECOND, FIRST))


def _blocks(documents: DataFrame, text: str, keep: list[str], opened: tuple) -> DataFrame:
    """``block, row, codes, steps`` per document and ``block, a, b, n`` (pairs and their documents) per block."""
    row = T.StructType([documents.schema[c] for c in keep])
    schema = T.StructType().add("block", "long").add("row", row).add("codes", "binary").add("steps", "binary")
    for c in ("a", "b", "n"):
        schema.add(c, T.ArrayType(T.IntegerType()))

    def block(number: int, rows: pa.Array, texts: list[str]) -> Iterator[pa.RecordBatch]:
        first, second = _sides(*opened)
        raw = [(" " + t).encode() if t else b"" for t in texts]
        a_ids, b_ids = first.ids(texts, raw), second.ids(texts, raw)
        empty = np.zeros(0, np.int64)
        aligned = [bool(r) and a is not None and b is not None for r, a, b in zip(raw, a_ids, b_ids)]
        a_ids = [a if ok else empty for ok, a in zip(aligned, a_ids)]
        b_ids = [b if ok else empty for ok, b in zip(aligned, b_ids)]
        doc_of_a = np.repeat(np.arange(len(texts)), np.fromiter(map(len, a_ids), np.int64, len(texts)))
        a_flat, b_flat = np.concatenate(a_ids), np.concatenate(b_ids)
        a, b, step = links(first.sizes[a_flat], second.sizes[b_flat])
        doc = doc_of_a[a]
        pairs, code, often = np.unique(a_flat[a] * len(second.sizes) + b_flat[b], return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")  # frequent pairs get small numbers, which pack well
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs, code = pairs[order], place[code]
        held = np.bincount(np.unique(code * len(texts) + doc) // len(texts), minlength=len(pairs))
        cuts = np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1]
        n = len(texts)

        def numbers(values):
            return pa.array([values.astype(np.int32)] + [None] * n, pa.list_(pa.int32()))

        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (n + 1), pa.int64()),
                pa.concat_arrays([pa.nulls(1, rows.type), rows]),
                pa.array([None, *map(pack_numbers, np.split(code, cuts))], pa.binary()),
                pa.array([None, *(zstandard.compress(s.astype(np.uint8).tobytes(), 1) for s in np.split(step, cuts))], pa.binary()),
                numbers(pairs // len(second.sizes)),
                numbers(pairs % len(second.sizes)),
                numbers(held),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows: list[pa.Array] = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            begin = 0
            for k, t in enumerate(strings(batch.column("text"))):
                texts.append(t)
                size += len(t) + 1
                if size >= BLOCK:
                    rows.append(batch.column("row").slice(begin, k + 1 - begin))
                    yield from block(number, pa.concat_arrays(rows), texts)
                    rows, texts, size, number, begin = [], [], 0, number + 1, k + 1
                    tidy()
            if begin < batch.num_rows:
                rows.append(batch.column("row").slice(begin))
        if texts:
            yield from block(number, pa.concat_arrays(rows), texts)

    packed = documents.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    return bucketed(packed.mapInArrow(run, schema), "block", "alignment")


def _texts(ids: np.ndarray, sep: np.ndarray, tables: tuple[np.ndarray, ...]) -> str:
    out = np.empty(len(ids), object)
    for k, table in enumerate(tables):
        at = sep == k
        out[at] = table[ids[at]]
    return "".join(out.tolist())[:-1]


def group_text(a: np.ndarray, b: np.ndarray, step: np.ndarray, tables: tuple[np.ndarray, ...]) -> str:
    """Groups as ``a1,a2|b1;a3|b2,b3`` from the ids and the step of every link. ``tables`` hold each id with ``,|;``."""
    if not len(step):
        return ""
    group = np.cumsum(step == BOTH)
    new_a, new_b = step != SECOND, step != FIRST
    ids = np.concatenate([a[new_a], b[new_b]])
    side = np.repeat([0, 1], [int(new_a.sum()), int(new_b.sum())])
    of = np.concatenate([group[new_a], group[new_b]])
    order = np.argsort(2 * of + side, kind="stable")
    ids, of, side = ids[order], of[order], side[order]
    sep = np.full(len(ids), 2)
    sep[:-1] = np.where(of[1:] != of[:-1], 2, np.where(side[1:] != side[:-1], 1, 0))
    return _texts(ids, sep, tables)


def aligned(documents: DataFrame, tokenizer: str, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and the ``groups`` of every whole text.

    ``tokenizer`` (byte-level BPE, A) reads a space and the text, ``model`` (SentencePiece BPE, B) the text, before which it
    puts a space itself. ``groups`` lists the ids of both between common cuts, as ``a1,a2|b1;a3|b2,b3``. ``n_best`` counts
    the links whose pair is in as many documents as the best pair of its A id, ties included; ``count_sum`` adds up the
    documents of every link's pair.

    Null and empty texts, and texts whose tokens do not spell them (U+2581 is a space to B), have no tokens: zeros and an
    empty ``groups``. Every row is a document of its own, also where rows or ids repeat. An empty table gives no rows.
    Columns outside ``keep`` do not matter, whatever their names; kept columns named like a result give way to it.
    """
    spark = documents.sparkSession
    ship(spark)
    results = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    kept = [c for c in keep if c not in (*results, "groups")]
    opened = uuid.uuid4().hex, spark.sparkContext.broadcast((bpe.tokenizer_arrays(tokenizer), piece_arrays(model)))
    table = _blocks(documents, text, kept, opened)
    rows = table.where("a IS NULL").select("block", "row", "codes", "steps")
    entries = table.where("a IS NOT NULL").selectExpr("block", "inline(transform(a, (x, k) -> struct(k AS code, x AS a, b[k] AS b, n[k] AS n)))")
    counts = stored(entries.groupBy("a", "b").agg(F.sum("n").alias("count")), "pair-counts")
    best = counts.groupBy("a").agg(F.max("count").alias("best"))
    known = counts.join(F.broadcast(best), "a").selectExpr("a", "b", "count", "count = best AS is_best")
    pairs = entries.drop("n").join(known, ["a", "b"]).selectExpr("block AS its_block", "code", "a", "b", "count", "is_best")
    schema = T.StructType(list(rows.schema["row"].dataType.fields))
    for c in results:
        schema.add(c, "long")
    schema.add("groups", "string")

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        first, second = _sides(*opened)
        spelt = np.array([str(k) for k in range(max(len(first.sizes), len(second.sizes)))], object)
        tables = spelt + ",", spelt + "|", spelt + ";"
        order = np.argsort(right["code"].to_numpy())
        a, b, count, is_best = (right[c].to_numpy()[order].astype(np.int64) for c in ("a", "b", "count", "is_best"))
        out = []
        for batch in left.to_batches(max_chunksize=1_000):
            found = []
            for codes, steps in zip(batch.column("codes").to_pylist(), batch.column("steps").to_pylist()):
                code = unpack_numbers(codes)
                step = np.frombuffer(zstandard.decompress(steps), np.uint8)
                found.append((
                    int((step != SECOND).sum()), int((step != FIRST).sum()), int((step == BOTH).sum()), len(step),
                    int(is_best[code].sum()), int(count[code].sum()), group_text(a[code], b[code], step, tables),
                ))
            columns = [batch.column("row").field(c) for c in kept]
            columns += [pa.array(c, pa.int64()) for c in list(zip(*found))[:-1]]
            out.append(pa.RecordBatch.from_arrays([*columns, pa.array([f[-1] for f in found], pa.string())], names=schema.names))
        tidy()
        return pa.Table.from_batches(out)

    return rows.groupBy("block").cogroup(pairs.groupBy("its_block")).applyInArrow(join, schema)
