"""The prefix tree of conversations: every distinct sequence of first turns is a node.

1. Turns are cut by range over ``(conversation, turn)``, not by conversation, so one conversation may lie on many tasks.
   A task walks over its turns on arrays; only what the last conversation of a task carries on to the next one (a few
   numbers per task) goes through the driver. Every prefix gets a 128-bit hash: the exclusive or of the hashes of its
   turns, each mixed with its place.
2. Conversations are put into an order in which those with a common prefix are neighbours. The key of a conversation
   holds only the steps behind which fewer conversations go along; its length is below the root of twice the number of
   turns, since k such steps need conversations that leave after 1, 2, ... k of them.
3. Neighbours' common depths are the edges of a union-find in descending depth (``forest``). Every task contracts its
   stretch of the order to the outer paths, and contracted stretches are joined in a few rounds over the boundaries.
4. Chains that come out of it are unfolded to nodes.

Only rows with numbers are shuffled, never texts. Keys that many rows share (first turns, long conversations, groups of
copies) are counted with a map-side part and joined by a broadcast: at most ``HOT`` keys can hold a ``HOT``-th of all.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagesift.llm.common import ship, stored, tidy
from pagesift.llm.forest import Chain, Element, Item, Part, contract, edge_between, finish, side_by_side

HOT = 10_000  # a key that holds more than one row in so many is joined by a broadcast
CHUNK = 50_000  # sequences that a task contracts at once
MERGED = 32  # contracted parts that one task joins in a round
STRETCH = 500_000  # turns that lie in one row after they are sorted
PIECE = 65_536  # characters of a list of conversations that travel as one row

_TURNS = "conv_id long, depth long, p1 long, p2 long, q1 long, q2 long, points long, size long"
_CHAIN_NAMES = ["conv_id", "low", "high", "n_convs", "n_leaves", "n_children", "below", "points", "p1", "p2", "q1", "q2", "task", "part"]
_CHAINS = ", ".join(f"{c} long" for c in _CHAIN_NAMES[:-1]) + ", part binary"
_STRETCH = ["conv_id", "own", "d1", "d2", "size"]
_ENDS = ["task", "number", "first", "conv", "lent", "own", "p1", "p2", "points"]
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


@dataclass(frozen=True)
class Lending:
    """Conversation c starts with the first turns of conversation ``c - c % group``, in place of as many of its own: the
    CRC-32 of c in decimal modulo ``most`` says how many."""

    group: int = 100
    most: int = 6

    def turns(self, conv_id: Column) -> Column:
        return F.crc32(conv_id.cast("string")) % self.most


@dataclass
class _Carry:
    """What the rows of a conversation before some place add up to: lent turns, own turns, prefix, code points."""

    conv: int | None = None
    lent: int = 0
    own: int = 0
    p1: int = 0
    p2: int = 0
    points: int = 0


def _mixed(a: np.ndarray, place: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = a ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _walk(batch: pa.RecordBatch, now: _Carry, most: int) -> tuple[pa.RecordBatch, _Carry]:
    """Rows of rebuilt turns from a stretch of sorted turns, and what they carry on."""
    conv, own, d1, d2, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("conv_id", "own", "d1", "d2", "size"))
    new = np.concatenate([[conv[0] != now.conv], conv[1:] != conv[:-1]])
    run = np.cumsum(new) - 1 + (not new[0])  # number of the conversation in this batch
    heads = np.flatnonzero(np.concatenate([[True], new[1:]]))
    goes_on = not new[0]

    def since_head(values: np.ndarray, carried: int) -> np.ndarray:
        total = np.cumsum(values)
        out = total - (total[heads] - values[heads])[run]
        return out + np.where(run == 0, carried, 0) if goes_on else out

    own_rank = since_head(own, now.own)
    lent = since_head(1 - own, now.lent)
    taken = np.array([zlib.crc32(str(c).encode()) % most if most else 0 for c in conv[heads].tolist()], np.int64)[run]
    keep = (own == 0) | (own_rank > taken)
    depth = lent + np.where(own == 1, own_rank - taken, 0)
    size = np.where(keep, size, 0)
    points = since_head(size, now.points)
    prefixes = []
    for values, salt, carried in ((d1, 1, now.p1), (d2, 2, now.p2)):
        own_bits = np.where(keep, _mixed(values.view(np.uint64), depth, salt), np.uint64(0))
        upto = np.bitwise_xor.accumulate(own_bits)
        behind = upto ^ (upto[heads] ^ own_bits[heads])[run]
        if goes_on:
            behind = behind ^ np.where(run == 0, np.uint64(carried), np.uint64(0))
        prefixes += [behind, behind ^ own_bits]
    after = _Carry(int(conv[-1]), int(lent[-1]), int(own_rank[-1]), int(prefixes[0][-1]), int(prefixes[2][-1]), int(points[-1]))
    p1, q1, p2, q2 = (np.ascontiguousarray(x).view(np.int64) for x in prefixes)
    columns = [x[keep] for x in (conv, depth, p1, p2, q1, q2, points, size)]
    names = ["conv_id", "depth", "p1", "p2", "q1", "q2", "points", "size"]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=names), after


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as stretches of at most ``STRETCH`` rows: one row each, so that its turns stay together in order."""
    task, number, held, n = TaskContext.get().partitionId(), 0, [], 0

    def stretch() -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        lists = [pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole[c].combine_chunks()) for c in _STRETCH]
        return pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([number], pa.int64()), *lists], names=["task", "number", *_STRETCH])

    for batch in batches:
        for k in range(0, batch.num_rows, STRETCH):
            part = batch.slice(k, STRETCH).select(_STRETCH)
            if n + part.num_rows > STRETCH:
                yield stretch()
                held, n, number = [], 0, number + 1
            held.append(part)
            n += part.num_rows
    if held:
        yield stretch()


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            columns = [row.column(c).flatten() for c in _STRETCH]
            place = row.column("task")[0].as_py(), row.column("number")[0].as_py()
            yield place, pa.RecordBatch.from_arrays(columns, names=_STRETCH)


def _carries(stretches: DataFrame, most: int) -> dict[tuple[int, int], _Carry]:
    """What the first conversation of every stretch brings from those before; one row per stretch is read for it, twice."""
    found: dict[tuple[int, int], _Carry] = {}
    for counted in (False, True):  # places first, then the prefixes that depend on them

        def last(batches: Iterator[pa.RecordBatch], carried=dict(found)) -> Iterator[pa.RecordBatch]:
            for place, part in _stretches(batches):
                before = carried.get(place, _Carry())
                _, now = _walk(part, _Carry(before.conv, before.lent, before.own), most)
                first = part.column("conv_id")[0].as_py()
                values = [*place, first, now.conv, now.lent, now.own, _signed(now.p1), _signed(now.p2), now.points]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=_ENDS)

        ends = sorted(stretches.mapInArrow(last, ", ".join(f"{c} long" for c in _ENDS)).collect())
        carries, before = {}, _Carry()
        for task, number, first, conv, lent, own, p1, p2, points in ends:
            goes_on = before.conv == first
            carries[task, number] = before if goes_on else _Carry()
            now = _Carry(conv, lent, own, p1 & _MASK, p2 & _MASK, points)
            if goes_on and conv == first:
                if not counted:
                    now.lent, now.own = lent + before.lent, own + before.own
                now.p1, now.p2, now.points = now.p1 ^ before.p1, now.p2 ^ before.p2, points + before.points
            before = now
        found = carries
    return {place: now for place, now in found.items() if now.conv is not None}


_MASK = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def rebuilt_turns(conversations: DataFrame, lending: Lending | None = None) -> DataFrame:
    """``conv_id, depth, p1, p2, q1, q2, points, size`` of every turn of every rebuilt conversation.

    ``p`` is the hash of the prefix that ends with the turn, ``q`` of the one before it; ``size`` are the code points of
    the text, ``points`` those up to here.
    """
    spark = conversations.sparkSession
    ship(spark)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(1).cast("long").alias("own"),
        F.col("turn").alias("turn"),
        F.xxhash64(F.lit(1), F.length(role), role, text).alias("d1"),
        F.xxhash64(F.lit(2), F.length(text), text, role).alias("d2"),
        F.length(text).cast("long").alias("size"),
    )
    most = 0
    if lending:
        most = lending.most
        in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "d1", "d2")
        first = turns.where(F.col("conv_id") % lending.group == 0).withColumn("place", F.row_number().over(in_order))
        first = first.where(F.col("place") < most).select(F.col("conv_id").alias("base"), "place", "d1", "d2", "size")
        borrowers = turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % lending.group)
        lent = borrowers.join(first, "base").where(F.col("place") <= lending.turns(F.col("conv_id")))
        turns = turns.unionByName(lent.select("conv_id", F.lit(0).cast("long").alias("own"), F.col("place").cast("long").alias("turn"), "d1", "d2", "size"))
    keys = [F.col("conv_id"), F.col("own"), F.col("turn").asc_nulls_first(), F.col("d1"), F.col("d2")]
    ordered = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*_STRETCH)
    arrays = "task long, number long, " + ", ".join(f"{c} array<long>" for c in _STRETCH)
    stretches = stored(ordered.mapInArrow(_packed, arrays), "turns-in-order")
    carried = _carries(stretches, most)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, part in _stretches(batches):
            yield _walk(part, carried.get(place, _Carry()), most)[0]

    return stored(stretches.mapInArrow(walk, _TURNS), "prefixes")


def _joined(rows: DataFrame, table: DataFrame, on: list[str], weight: Column, total: int) -> DataFrame:
    """``rows`` joined with ``table``, whose keys are unique; ``weight`` says how many rows a key may meet, ``total`` how
    many these are in all. Keys that meet more than a ``HOT``-th of them are fewer than ``HOT``, and are broadcast."""
    limit = max(1, total // HOT)
    hot, cold = table.where(weight > limit), table.where(weight <= limit)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(others.join(cold, on))


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Final chains of a task's stretch of the sorted sequences, and one row with what is left of the stretch."""
    whole: Part | None = None

    def close(rows: list[tuple[list[Element], Item]]) -> list[Chain]:
        nonlocal whole
        edges = [edge_between(a[0], b[0]) for a, b in zip(rows, rows[1:])]
        part, chains = contract(Part([r[1] for r in rows], edges, rows[0][0], rows[-1][0]))
        if whole:
            part, more = contract(side_by_side(whole, part))
            chains += more
        whole = part
        return chains

    held: list[tuple[list[Element], Item]] = []
    for batch in batches:
        names = ("key", "length", "points", "p1", "p2", "n_convs", "conv_id")
        for key, length, points, p1, p2, n, conv in zip(*(batch.column(c).to_pylist() for c in names)):
            steps = [Element(e["depth"], (e["p1"], e["p2"]), e["before"], (e["q1"], e["q2"])) for e in key]
            held.append((steps, Item(length, points, (p1, p2), n, conv)))
            if len(held) >= CHUNK:
                yield _chain_rows(close(held))
                held = []
    if held:
        yield _chain_rows(close(held))
    if whole:
        yield _part_row(TaskContext.get().partitionId(), whole)
    tidy()


def _chain_rows(chains: list[Chain]) -> pa.RecordBatch:
    columns = [[getattr(c, f) for c in chains] for f in ("least", "low", "high", "n", "leaves", "children", "below", "points")]
    columns += [[c.prefix[0] for c in chains], [c.prefix[1] for c in chains], [c.parent[0] for c in chains], [c.parent[1] for c in chains]]
    arrays = [pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(chains), pa.int64()), pa.nulls(len(chains), pa.binary())], names=_CHAIN_NAMES)


def _part_row(task: int, part: Part) -> pa.RecordBatch:
    arrays = [pa.nulls(1, pa.int64())] * 12
    return pa.RecordBatch.from_arrays([*arrays, pa.array([task], pa.int64()), pa.array([pickle.dumps(part)], pa.binary())], names=_CHAIN_NAMES)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring parts, sorted by task, joined over their boundaries, one group after the other."""
    whole, group = None, None
    for batch in batches:
        for task, data in zip(batch.column("task").to_pylist(), batch.column("part").to_pylist()):
            if group is not None and task // MERGED != group:
                yield _part_row(group, whole)
                whole = None
            group, part = task // MERGED, pickle.loads(data)
            if whole:
                part, chains = contract(side_by_side(whole, part))
                yield _chain_rows(chains)
            whole = part
    if whole:
        yield _part_row(group, whole)


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("part").to_pylist():
            yield _chain_rows(finish(pickle.loads(data)))


def _chains(sequences: DataFrame) -> DataFrame:
    """All chains of the tree of ``sequences`` by sorting them, contracting stretches and merging these in rounds."""
    ordered = sequences.repartitionByRange("key").sortWithinPartitions("key")
    found = stored(ordered.mapInArrow(_contracted, _CHAINS), "chains")
    final, parts = found.where("part IS NULL"), found.where("part IS NOT NULL").select("task", "part")
    while parts.count() > 1:
        groups = parts.repartition(F.expr(f"task DIV {MERGED}")).sortWithinPartitions("task")
        found = stored(groups.mapInArrow(_merged, _CHAINS), "chains")
        final, parts = final.unionByName(found.where("part IS NULL")), found.where("part IS NOT NULL").select("task", "part")
    return stored(final.unionByName(parts.mapInArrow(_finished, _CHAINS)).drop("task", "part"), "chains")


def _ends(ends: DataFrame) -> DataFrame:
    """``length, p1, p2, ends_sha256``: the hash of the sorted conversations that end with each prefix.

    Conversations are cut by range, so a prefix at which very many end lies on many tasks. These write their stretch of
    the list as pieces of text; only the pieces of one prefix meet, and its hash reads them one after the other.
    """
    key = ["length", "p1", "p2"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for *prefix, conv in zip(*(batch.column(c).to_pylist() for c in (*key, "conv_id"))):
                if prefix != now or size > PIECE:
                    if held:
                        out.append((*now, first, ",".join(held)))
                    now, first, held, size = prefix, conv, [], 0
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield _rows(out, [*key, "first", "piece"])
        if held:
            yield _rows([(*now, first, ",".join(held))], [*key, "first", "piece"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for *prefix, piece in zip(*(batch.column(c).to_pylist() for c in (*key, "piece"))):
                if prefix != now:
                    if now:
                        out.append((*now, digest.hexdigest()))
                    now, digest = prefix, hashlib.sha256(piece.encode())
                else:
                    digest.update(f",{piece}".encode())
            if out:
                yield _rows(out, [*key, "ends_sha256"])
        if now:
            yield _rows([(*now, digest.hexdigest())], [*key, "ends_sha256"])

    in_order = ends.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    cut = in_order.mapInArrow(pieces, "length long, p1 long, p2 long, first long, piece string")
    met = cut.repartition(*key).sortWithinPartitions(*key, "first")
    return met.mapInArrow(hashes, "length long, p1 long, p2 long, ends_sha256 string")


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if isinstance(c[0], str) else pa.int64()) for c in zip(*rows)], names=names)


def prefix_trie(conversations: DataFrame, lending: Lending | None = None) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A node is a distinct sequence of first turns (role and text; null counts as empty) of the conversations, which
    ``lending`` may have rebuilt; ``conv_id`` is the smallest conversation that starts so, and the node's text is turn
    ``depth`` of it. Turns are ordered by ``turn``, null first, and turns with one number by a hash of role and text. A
    repeated row is a turn of its own. Rows without ``conv_id`` belong to no conversation and are left out; a table
    without conversations has no nodes, not even the root. Other columns do not matter, whatever their names. Two
    prefixes count as one if 128 bits of hash agree.
    """
    turns = rebuilt_turns(conversations, lending)
    everyone = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"))
    none = everyone.distinct().selectExpr("conv_id", "0L AS length", "0L AS p1", "0L AS p2", "0L AS points")
    deepest = F.max(F.struct("length", "p1", "p2", "points")).alias("e")
    ends = stored(turns.withColumnRenamed("depth", "length").select(none.columns).unionByName(none).groupBy("conv_id").agg(deepest).select("conv_id", "e.*"), "ends")
    sums = ends.agg(F.count("*"), F.sum("length"), F.min("conv_id")).first()
    n_convs, n_turns = sums[0], sums[1] or 0
    if not n_convs:
        return turns.sparkSession.createDataFrame([], NODE)
    # every node with its parent's number of conversations: fewer conversations go along behind a branch
    node = ["depth", "p1", "p2"]
    nodes = stored(
        turns.groupBy(*node).agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.first(c).alias(c) for c in ("q1", "q2", "points", "size"))
        ),
        "nodes",
    )
    root = turns.sparkSession.createDataFrame([(0, 0, 0, sums[2], n_convs, 0, 0, 0, 0)], nodes.schema)
    above = nodes.unionByName(root).selectExpr("depth + 1 AS depth", "p1 AS q1", "p2 AS q2", "n_convs AS n_above")
    branches = _joined(nodes, above, ["depth", "q1", "q2"], F.col("n_above"), n_turns).where("n_convs < n_above")
    branches = stored(branches.select(*node, "n_convs"), "branches")
    steps = _joined(turns, branches, node, F.col("n_convs"), n_turns)
    step = F.struct("depth", "p1", "p2", (F.col("points") - F.col("size")).alias("before"), "q1", "q2")
    keys = steps.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("key"))
    classes = ends.groupBy("length", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("points").alias("points"))
    none_yet = F.lit([]).cast(keys.schema["key"].dataType)
    sequences = classes.join(keys, "conv_id", "left").withColumn("key", F.coalesce("key", none_yet))
    chains = _chains(sequences)
    # each chain with its parent's conversation and the hash of its ends, then unfolded to its nodes
    parents = chains.selectExpr("high + 1 AS low", "p1 AS q1", "p2 AS q2", "conv_id AS parent", "n_children AS met")
    joined = _joined(chains.where("low > 0"), parents, ["low", "q1", "q2"], F.col("met"), 2 * n_convs).drop("met")
    whole = joined.unionByName(chains.where("low = 0").withColumn("parent", F.lit(None).cast("long")))
    whole = whole.join(_ends(ends).withColumnRenamed("length", "high"), ["high", "p1", "p2"], "left").drop("p1", "p2", "q1", "q2")
    whole = whole.withColumnRenamed("points", "points_below")
    rows = nodes.unionByName(root).select("conv_id", "n_convs", "depth", "points", "size")
    unfolded = _joined(rows, whole, ["conv_id", "n_convs"], F.col("high") - F.col("low") + 1, n_turns + 1)
    at_end = F.col("depth") == F.col("high")
    return unfolded.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("low"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(at_end, F.col("n_children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("points_below") - F.col("points") + F.col("size"))).alias("saved_tokens"),
        F.coalesce(F.when(at_end, F.col("ends_sha256")), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
