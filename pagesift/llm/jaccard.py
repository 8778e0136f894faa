"""Documents whose word shingles agree: an exact Jaccard join by size-banded tiles and bitmap signatures.

*Candidates.* Sets of similarity J or more differ in at most H = (1 - J) / (1 + J) * (|x| + |y|) elements. The shingles of
a set are dealt by hash into P > H parts, so two such sets agree in at least P - H whole parts; the number of parts
is fixed for a band of sizes (a power of two), and a set that can pair with the next band appears there too. A tile is
what shares a band, a part and the part's content, so a line or passage that a third of all documents have does not by
itself bring them together. Parts with few shingles agree by chance, the more so the more documents there are, and empty
parts always. Parts are therefore put in one order for all sets, the fullest first, and a set appears under its first
H + 1 only, H being that of its own size: of the P - H parts in which two sets agree, the first one has at least
P - H - 1 behind it, so it is among the first H + 1 of both and nothing is lost.

*Checks.* A signature is a bitmap in which every shingle flips one bit; the number of differing bits is at most the number
of differing shingles, which bounds the overlap from above. Survivors are compared by intersecting sorted arrays.

*Without all pairs.* Equal sets are one class. In a first round each class is compared with at most two of the first
classes of its tiles, which links much of a group at a cost that follows its size. What is linked then is one component,
and two later rounds look at pairs of different components only, in tiles cut into squares of bounded size. The first takes
from each square a least spanning forest of the signatures' distances, so a square hands on fewer pairs than it has
classes; the last takes every pair that is still between components. Every link is thus either verified or lies
within a component already. A tile is also cut where, in order of size, two neighbours differ too much in size, and
of the tiles that hold the same classes only one is looked at.

Signatures travel with the candidates; shingles are made again from the texts, and only for documents whose candidates
pass the signatures. A bitmap of fixed size over their ids keeps the other texts out of the shuffle.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing. A text with fewer
words than a shingle is one shingle. Rows with equal ``doc_id`` are one document with several texts: their classes are
joined. A row without ``doc_id`` links others, but has no id to lend; its component may be null.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.bpe import _powers
from pagesift.llm.common import arrow_rows, components, drop, new_dir, release, scratch, ship, stored, strings, tidy, trimmed

SPARE = 3  # for so many parts that are needed, one more: those with the fewest shingles can then be left out
TILE = 2_048
CHUNK = 250_000  # characters that are handled at once: some 50 bytes of arrays stand behind each
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``words`` words; links where ``of * intersection >= share * union``."""

    words: int = 5
    share: int = 80
    of: int = 100

    def differing(self, total):
        """Most elements in which two linked sets of ``total`` elements together can differ."""
        return (self.of - self.share) * total // (self.of + self.share)

    def linked(self, both: int, total: int) -> bool:
        return self.of * both >= self.share * (total - both)

    def parts(self, band: int) -> int:
        most = self.differing(2 * (2 ** (band + 1) - 1))
        return most + 2 + most // SPARE if most else 0

    def kept(self, n: int, band: int) -> int:
        """Under how many of its parts a set of ``n`` elements appears in a band: one more than it can differ in there."""
        return self.differing(n + min(n * self.of // self.share, 2 ** (band + 1) - 1)) + 1

    def bands(self, n: int) -> list[int]:
        own = n.bit_length() - 1
        return [own, own + 1] if n * self.of >= self.share * 2 ** (own + 1) else [own]


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < CHUNK):
            size += len(texts[end])
            end += 1
        yield from _sets_of_chunk(texts[at:end], words)
        at = end


def _sets_of_chunk(texts: list[str], words: int) -> Iterator[np.ndarray]:
    raw = [t.encode() for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    heads = np.cumsum([0, *(len(r) + 1 for r in raw)])
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    powers = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)])])
        h = _mix((sums[ends] - sums[starts]) * _powers(len(data) + 1, inverse=True)[starts])
        first = np.searchsorted(starts, heads)
        n = len(h) - words + 1
        rolled = np.zeros(max(n, 0), np.uint64)
        for k in range(words if n > 0 else 0):
            rolled = _mix(rolled * np.uint64(3) + h[k : k + n])
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                whole = np.full(1, b - a, np.uint64)  # the number of words goes in: no full shingle starts like that
                for x in h[a:b]:
                    whole = _mix(whole * np.uint64(5) + x)
                yield whole
            else:
                yield rolled[:0]


def signature(shingles: np.ndarray) -> bytes:
    """Parity bitmap with the next power of two above the size as bits, at least 256: sets without much in common differ in
    half as many bits as they have shingles, linked ones in less than a quarter."""
    bits = max(256, 1 << len(shingles).bit_length())
    flips = np.bincount((_mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(bool), bitorder="little").tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit numbers) folded to ``size`` numbers: the parity of the shorter hash."""
    while bits.shape[1] > size:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def part_keys(shingles: np.ndarray, how: Similarity) -> np.ndarray:
    """Hashes of (band, part, content) under which the set appears: its fullest parts, those of one size by their hash."""
    out = []
    low = _mix(shingles ^ np.uint64(0x2545F4914F6CDD1D))
    place = _mix(shingles + np.uint64(0x632BE59BD9B4E019))
    for band in how.bands(len(shingles)) if len(shingles) else []:
        parts = how.parts(band)
        if not parts:
            continue
        part = (place % np.uint64(parts)).astype(np.int64)
        count = np.bincount(part, minlength=parts)
        halves = [np.bincount(part, w.astype(np.float64), parts).astype(np.uint64) for w in (low & np.uint64(0xFFFFFFFF), low >> np.uint64(32))]
        with np.errstate(over="ignore"):
            content = halves[0] + (halves[1] << np.uint64(32)) + count.astype(np.uint64)
            keys = _mix(_mix(content) + np.arange(parts, dtype=np.uint64) * np.uint64(64) + np.uint64(band))
        out.append(keys[np.lexsort((keys, -count))[: how.kept(len(shingles), band)]])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def class_of(shingles: np.ndarray) -> int:
    """One number for equal sets, by two sums over the shingles."""
    with np.errstate(over="ignore"):
        a = _mix(shingles).sum(dtype=np.uint64)
        b = _mix(shingles ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
        return int(_mix(np.array([a ^ (b * np.uint64(3)) ^ np.uint64(len(shingles))]))[0].view(np.int64))


_NO_KEYS = np.zeros(0, np.int64)
_SETS = "doc_id long, n long, cls long, keys array<long>, bits binary"
_ARRAYS = "cls long, shingles array<long>"


def _batches(batches, size: int = 1_000):
    for batch in batches:
        for k in range(0, batch.num_rows, size):
            yield batch.slice(k, size)


def _sets(how: Similarity):
    def run(batches):
        seen: set[int] = set()  # classes of this task: only the first row of each brings its keys
        for batch in _batches(batches):
            rows = []
            for s in shingle_sets(strings(batch.column("_text")), how.words):
                cls = class_of(s) if len(s) else None
                new = cls is not None and cls not in seen
                seen.add(cls)
                rows.append((len(s), cls, part_keys(s, how).view(np.int64) if new else _NO_KEYS, signature(s) if new else None))
            keys = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[2]) for r in rows)]), pa.int32()), pa.array(np.concatenate([r[2] for r in rows])))
            tidy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), keys, pa.array([r[3] for r in rows], pa.binary())],
                names=["doc_id", "n", "cls", "keys", "bits"],
            )

    return trimmed(run)


def _arrays(how: Similarity):
    def run(batches):
        for batch in _batches(batches):
            sets = [s for s in shingle_sets(strings(batch.column("_text")), how.words) if len(s)]
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in sets], pa.int64()), lists],
                names=["cls", "shingles"],
            )

    return trimmed(run)


_TILED = pa.schema([("key", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("first", pa.int64()), ("m", pa.int64())])


def _runs(how: Similarity):
    """Rows sorted by key, size and class -> those that have a neighbour of their key and of a fitting size, with the
    first class of such a run and its size. A class that comes twice under a key counts once."""

    def run(batches):
        last = None  # key, class, size, first class and its size of the last row, and whether it has been put out
        for batch in batches:
            if not batch.num_rows:
                continue
            key, cls, n = (np.asarray(batch.column(c)) for c in ("key", "cls", "n"))
            if last is not None:
                key, cls, n = (np.concatenate([[v], x]) for v, x in zip(last, (key, cls, n)))
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
            key, cls, n = key[fresh], cls[fresh], n[fresh]
            begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (how.share * n[1:] > how.of * n[:-1])]))
            size = np.diff(np.append(begin, len(key)))
            first, m, many = cls[begin].copy(), n[begin].copy(), size > 1
            if last is not None:
                first[0], m[0] = last[3], last[4]
                many[0] |= last[5]
            out = np.repeat(many, size)
            first_of, m_of = np.repeat(first, size), np.repeat(m, size)
            last_out = bool(out[-1])
            if last is not None and last[5]:
                out[0] = False  # has been put out with the batch before
            yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, cls, n, first_of, m_of)], schema=_TILED)
            last = (int(key[-1]), int(cls[-1]), int(n[-1]), int(first_of[-1]), int(m_of[-1]), last_out)

    return trimmed(run)


def _sift(how: Similarity):
    """Pairs with both signatures -> those that the signatures do not rule out."""

    def run(batches):
        for batch in batches:
            total = np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b"))
            good = np.zeros(batch.num_rows, bool)
            for k, (bits_a, bits_b) in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())):
                maps = [np.frombuffer(v, np.uint64)[None, :] for v in (bits_a, bits_b)]
                size = min(m.shape[1] for m in maps)
                good[k] = int(np.bitwise_count(fold(maps[0], size) ^ fold(maps[1], size)).sum()) <= how.differing(int(total[k]))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return trimmed(run)


def _verify(how: Similarity):
    """Pairs with both sorted arrays -> those that are linked."""

    def run(batches):
        for batch in batches:
            sides = [batch.column(c) for c in ("shingles_a", "shingles_b")]
            flat = [np.asarray(s.values) for s in sides]
            offsets = [np.asarray(s.offsets) for s in sides]
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                x, y = (f[o[k] : o[k + 1]] for f, o in zip(flat, offsets))
                good[k] = how.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return trimmed(run)


FILTER_BITS = 22


def _some_of(documents: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``documents`` whose ``key`` is in ``wanted``: first by a bitmap of 2 ** 22 bits, which the driver hands to
    all tasks whatever the number of keys, then exactly. A full bitmap only means that more rows take the join."""
    slot = F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)
    cells = wanted.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 AS INT))")).alias("bits"))
    held = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in cells.toLocalIterator():
        held[r.word] = r.bits
    flags = documents.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for batch in batches:
            at = np.asarray(batch.column("_slot"))
            hit = (flags.value[at >> 6] >> (at & 63)) & 1
            yield batch.filter(pa.array(hit.astype(bool)))

    near = documents.withColumn("_slot", slot)
    return near.mapInArrow(run, near.schema).drop("_slot").join(wanted.select(key), key, "left_semi")


class _Square:
    """Classes of one square with their sizes, components and folded signatures."""

    def __init__(self, rows: dict[str, list], how: Similarity):
        self.how, self.across = how, rows["i"][0] != rows["j"][0]
        self.n, self.comp, self.side, self.cls = (np.array(rows[c], np.int64) for c in ("n", "comp", "part", "cls"))
        size = min(len(b) for b in rows["bits"]) // 8
        self.bits = np.concatenate([fold(np.frombuffer(b, np.uint64)[None, :], size) for b in rows["bits"]])

    def candidates(self, k: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``others`` that are of another component and that size and signature do not rule out, with distances."""
        low, high = np.minimum(self.n[k], self.n[others]), np.maximum(self.n[k], self.n[others])
        fits = (self.comp[others] != self.comp[k]) & (low * self.how.of >= self.how.share * high)
        if self.across:
            fits &= self.side[others] != self.side[k]
        others = others[fits]
        apart = np.bitwise_count(self.bits[others] ^ self.bits[k]).sum(axis=1, dtype=np.int64)
        near = apart <= self.how.differing(self.n[others] + self.n[k])
        return others[near], apart[near]

    def every_pair(self) -> tuple[list[int], list[int]]:
        out_a, out_b = [], []
        for k in range(len(self.n)):
            others, _ = self.candidates(k, np.arange(k + 1, len(self.n)))
            out_a += [int(self.cls[k])] * len(others)
            out_b += self.cls[others].tolist()
        return out_a, out_b

    def forest(self) -> tuple[list[int], list[int]]:
        """Pairs of a least spanning forest (Prim's way); classes of one component are at no distance from each other."""
        far, linked = 2**62, -1
        best, via = np.full(len(self.n), far), np.zeros(len(self.n), np.int64)
        left = np.arange(len(self.n))
        out_a, out_b = [], []
        while len(left):
            at = int(np.argmin(best[left]))
            k = int(left[at])
            if linked < best[k] < far:
                out_a.append(int(self.cls[k]))
                out_b.append(int(self.cls[via[k]]))
            left = np.delete(left, at)
            best[left[self.comp[left] == self.comp[k]]] = linked
            others, apart = self.candidates(k, left)
            nearer = apart < best[others]
            best[others[nearer]], via[others[nearer]] = apart[nearer], k
        return out_a, out_b


def _squares(how: Similarity, whole: bool):
    """Rows sorted by square -> pairs of classes of different components: all that are left, or those of a forest."""

    def pairs(rows: dict[str, list]) -> tuple[list[int], list[int]]:
        square = _Square(rows, how)
        return square.every_pair() if whole else square.forest()

    def run(batches):
        held: dict[str, list] = {}
        last = None
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("key", "first", "i", "j", "part", "cls", "comp", "n", "bits")}
            found_a, found_b = [], []
            tiles = list(zip(columns["key"], columns["first"], columns["i"], columns["j"]))
            start = 0
            while start < len(tiles):
                end = start
                while end < len(tiles) and tiles[end] == tiles[start]:
                    end += 1
                if tiles[start] != last:
                    if held:
                        for side, more in zip((found_a, found_b), pairs(held)):
                            side += more
                    held, last = {c: [] for c in columns}, tiles[start]
                for c in columns:
                    held[c] += columns[c][start:end]
                start = end
            yield pa.RecordBatch.from_arrays([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pairs(held)], names=["a", "b"])

    return trimmed(run)


def linked_documents(documents: DataFrame, how: Similarity = Similarity(), text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``."""
    spark = documents.sparkSession
    ship(spark)

    def written(df: DataFrame, name: str, rows: int = 4_000) -> DataFrame:
        path = new_dir(spark, name)
        with arrow_rows(spark, rows):
            df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))
    # the keys are by far the largest part, and are only needed for the tiles: their table goes when these are written
    with scratch(spark, "keys") as folder:
        with_keys = written(source.mapInArrow(_sets(how), _SETS), "shingle-sets")
    sets = written(with_keys.drop("keys"), "shingle-sets", 50_000)
    full = sets.where("n > 0")
    keyed = with_keys.where("n > 0").select(F.explode("keys").alias("key"), "cls", "n")
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key", "n", "cls")
    tiles = written(sorted_keys.mapInArrow(_runs(how), "key long, cls long, n long, first long, m long"), "tiles", 50_000)
    drop(spark, folder)
    signatures = full.where("bits IS NOT NULL").select("cls", "n", "bits")
    signatures = written(signatures.join(tiles.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "signatures")
    holder = F.coalesce("doc_id", F.lit(2**63 - 1))  # rows without id stand behind classes that no other row has

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("cls")), F.struct(F.col("b").alias("cls"))))).distinct()
        holders = full.join(wanted, "cls").groupBy("cls").agg(F.min(holder).alias("holder")).select("holder").distinct()
        holders = written(holders, "holders")
        again = _some_of(source.withColumn("holder", holder), holders, "holder").select("doc_id", "_text").mapInArrow(_arrays(how), _ARRAYS)
        arrays = again.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("shingles"))
        arrays = written(arrays, "shingle-arrays", 1_000)
        for side in ("a", "b"):
            pairs = pairs.join(arrays.select(F.col("cls").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
        return written(pairs.mapInArrow(_verify(how), "a long, b long"), "links", 500)

    def sifted(pairs: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(signatures.select(F.col("cls").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)
        return written(pairs.mapInArrow(_sift(how), "a long, b long"), "pairs")

    def between(so_far: DataFrame, whole: bool) -> DataFrame:
        """Verified links between the components so far, from squares of the tiles that hold more than one component."""
        labelled = tiles.select("key", "first", "cls", "n").join(so_far, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        same = [F.bit_xor(F.xxhash64("cls", F.lit(k))).alias(f"same{k}") for k in (0, 1)]
        mixed = labelled.groupBy("key", "first").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("cls").alias("held"), *same).where("low < high")
        # two sets that agree in one part mostly agree in many: of the tiles that hold the same classes one is looked at
        mixed = mixed.groupBy("held", "same0", "same1").agg(F.min(F.struct("key", "first")).alias("tile")).select("tile.*", "held")
        rest = labelled.join(mixed.select("key", "first", F.ceil(F.col("held") / TILE).cast("int").alias("squares")), ["key", "first"])
        rest = rest.withColumn("part", F.pmod(F.hash("cls"), F.col("squares")))
        rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("squares") - 1)))
        rest = rest.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}).drop("other", "squares")
        square = ["key", "first", "i", "j"]
        rest = rest.join(signatures.select("cls", "bits"), "cls").repartition(*square).sortWithinPartitions(*square, "n", "cls")
        pairs = rest.mapInArrow(_squares(how, whole), "a long, b long")
        return verified(written(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs"))

    # linear round: a class tries at most two of the first classes of its tiles
    fits = (F.col("m") * how.of >= F.col("n") * how.share) & (F.col("cls") != F.col("first"))
    tried = tiles.where(fits).groupBy("cls").agg(F.min("first").alias("x"), F.max("first").alias("y"))
    links = verified(sifted(tried.select(F.col("cls").alias("b"), F.explode(F.array_distinct(F.array("x", "y"))).alias("a")).select("a", "b")))
    for whole in (False, True):
        release(spark)
        so_far = components(links).select(F.col("node").alias("cls"), F.col("component").alias("comp"))
        links = links.unionByName(between(so_far, whole))

    # rows of one doc_id are one document
    spread = full.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z")
    own = full.join(spread.select("doc_id", "a"), "doc_id").select("a", F.col("cls").alias("b"))
    groups = components(links.unionByName(own)).withColumnRenamed("node", "cls")
    per_class = full.groupBy("cls").agg(F.min("doc_id").alias("least")).join(groups, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    named = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    known = per_class.join(named, "component").select("cls", "component_id")
    out = sets.select("doc_id", "n", "cls").join(known, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))).alias("component_id"))


def one_of_each(documents: DataFrame, how: Similarity = Similarity(), text: str = "text") -> DataFrame:
    """``documents`` without near copies: of each component the row with the smallest ``doc_id`` stays.

    Rows are linked, not ids: every row has a key of its own, the hash of its id and text, so unrelated texts under one id
    all stay and equal texts without id are copies. Rows that agree in id and text are one document, of which one row
    stays. Rows whose text is null or has no words stay as they are. Other columns may have any name.
    """
    spark = documents.sparkSession
    row, key = (f"_{n}_{uuid.uuid4().hex[:8]}" for n in ("row", "key"))
    keyed = documents.select(F.struct(*documents.columns).alias(row), F.xxhash64("doc_id", text).alias(key), F.col(text).alias("_text"))
    found = linked_documents(keyed.select(F.col(key).alias("doc_id"), "_text"), how, "_text").where("n_shingles > 0")
    found = stored(found.select(F.col("doc_id").alias(key), "component_id").distinct(), "near-copies")
    release(spark)
    names = keyed.select(key, F.col(row)["doc_id"].alias("name")).groupBy(key).agg(F.first("name").alias("name"), F.count("*").alias("rows"))
    place = F.struct(F.col("name").isNull(), "name", key)
    first = found.join(names, key).groupBy("component_id").agg(F.min(F.struct(place.alias("place"), "rows")).alias("first"))
    kept = stored(first.select(F.col("first.place")[key].alias(key), "first.rows"), "kept-rows")
    blank = ~F.regexp_like(F.coalesce("_text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    single = keyed.join(kept.where("rows = 1").select(key), key, "left_semi").select(row)
    # rows that repeat: one of each, chosen by task before they meet
    repeated = keyed.join(kept.where("rows > 1").select(key), key, "left_semi").groupBy(key).agg(F.first(row).alias(row)).select(row)
    return single.unionByName(repeated).unionByName(keyed.where(blank).select(row)).select(f"{row}.*")
