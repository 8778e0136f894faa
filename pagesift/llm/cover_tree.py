"""Near-duplicate vectors by dual traversal of cover trees: all pairs above a cosine threshold, exactly.

On unit vectors the cosine and the distance order pairs alike, so pairs within a distance are looked for. A cover tree
holds nested levels of centres: on each level the radius is half of the one before, every point lies within the radius
of its centre, and centres lie further apart than it. Two trees are walked together: a pair of nodes is dropped when
the distance of its centres exceeds both covering radii plus the threshold, is taken as a whole when every pair below
it must be within the threshold, and is opened otherwise. Pairs of single points are compared by their cosine.

Distances never grow in a projection, so centres are first compared in their first axes, with the norm of the rest as
one more: that bounds the cosine from above, and only what comes near the threshold there is compared as a whole.

Across the cluster, pivots (a bounded sample) are the top level: every vector goes to its nearest pivot's cell, cells are
cut into blocks of bounded size, and each block gets its tree once. Neighbouring blocks make a group. Groups all of whose
cells are kept apart by their covering radii are never brought together; of all others a task walks the trees of two
groups, so a tree is sent once per group and not once per tree. A task returns a count per vector and the edges of a
spanning forest, never all pairs, so a large group of copies costs no more than its members. Equal vectors are one node
with a weight from the start.

Vectors without any structure (random directions in many dimensions) leave nothing to prune between cells; the search
is then quadratic in products over the first axes, as every exact one is in something.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.common import components, ship, stored
from pagesift.llm.vectors import finite, matrix, pack, unpack

COSINE = 0.95
BLOCK = 2_048
MAX_PIVOTS = 1_024
GROUP = 64  # trees of a side that a task holds at most
GROUPS = 8  # groups to begin with: 36 tasks
AXES = 24  # axes that are compared first
TOP = 0.5  # radius of the first level below the root; balls much wider than a link rule out nothing
PAIRS = 500_000  # pairs of nodes that are compared at once
_NEAR = 1e-5  # rounding of products in single precision
_SAFE = 1e-6  # distances come from cosines, whose rounding grows to this near zero


class Tree:
    """A cover tree over unit vectors. Node i has centre ``centre[i]``, covering radius ``radius[i]``, the points
    ``order[low[i]:high[i]]`` and the children ``child[first[i]:first[i + 1]]``."""

    def __init__(self, x: np.ndarray, **parts: np.ndarray):
        self.x = x
        self.coarse = _coarse(x)
        self.parts = parts
        for name, value in parts.items():
            setattr(self, name, value)

    @classmethod
    def build(cls, x: np.ndarray) -> Tree:
        order = np.arange(len(x))
        centre, radius, low, high, children = [0], [0.0], [0], [len(x)], [[]]
        todo = [(0, TOP)]
        while todo:
            node, r = todo.pop()
            a, b = low[node], high[node]
            points = order[a:b]
            own = x[points]
            away = _distance(own @ x[centre[node]])
            radius[node] = float(away.max())
            if b - a == 1:
                radius[node] = 0.0
                continue
            if radius[node] <= _SAFE:  # below the rounding of distances: one child for each point
                for k, point in enumerate(points.tolist()):
                    children[node].append(len(centre))
                    centre.append(point)
                    radius.append(0.0)
                    low.append(a + k)
                    high.append(a + k + 1)
                    children.append([])
                continue
            while r >= radius[node]:
                r /= 2
            # greedy net: the node's own centre first, then whatever is not covered yet
            nearest, owner, centres = away, np.zeros(b - a, int), [centre[node]]
            while True:
                far = int(np.argmax(nearest > r))
                if nearest[far] <= r:
                    break
                centres.append(int(points[far]))
                d = _distance(own @ own[far])
                closer = d < nearest
                owner[closer] = len(centres) - 1
                nearest = np.where(closer, d, nearest)
            by = np.argsort(owner, kind="stable")
            order[a:b] = points[by]
            start = a
            for k, size in enumerate(np.bincount(owner, minlength=len(centres)).tolist()):
                if size:
                    children[node].append(len(centre))
                    todo.append((len(centre), r))
                    centre.append(centres[k])
                    radius.append(0.0)
                    low.append(start)
                    high.append(start + size)
                    children.append([])
                    start += size
        first = np.cumsum([0, *map(len, children)])
        child = np.array([c for group in children for c in group], np.int64)
        return cls(x, order=order, centre=np.array(centre), radius=np.array(radius), low=np.array(low), high=np.array(high), first=first, child=child)

    def below(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each node where its children begin in the last array, and how many it has; a leaf is its own child."""
        count = np.diff(self.first)
        leaves = np.flatnonzero(count == 0)
        start = self.first[:-1].copy()
        start[leaves] = len(self.child) + np.arange(len(leaves))
        return start, np.maximum(count, 1), np.concatenate([self.child, leaves])


def _coarse(x: np.ndarray) -> np.ndarray:
    """The first axes and the norm of the others: products of these are never below those of the whole vectors."""
    if x.shape[1] <= AXES + 8:
        return x.astype(np.float32)
    first = x[:, :AXES]
    rest = np.sqrt(np.maximum((x[:, AXES:] ** 2).sum(axis=1, keepdims=True), 0.0))
    return np.concatenate([first, rest], axis=1).astype(np.float32)


def _near(a: Tree, left: np.ndarray, b: Tree, right: np.ndarray, cosine: float, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of a node of ``left`` and one of ``right`` that may hold linked pairs, among all pairs of them."""
    found = []
    ra, rb = a.radius[left], b.radius[right]
    for p in (np.flatnonzero(ra == 0), np.flatnonzero(ra > 0)):
        for q in (np.flatnonzero(rb == 0), np.flatnonzero(rb > 0)):
            if len(p) and len(q):
                least = _least(ra[p].max(), rb[q].max(), cosine, limit)
                dots = a.coarse[a.centre[left[p]]] @ b.coarse[b.centre[right[q]]].T
                i, j = np.divmod(np.flatnonzero(dots >= np.float32(least - _NEAR)), len(q))
                found.append((p[i], q[j]))
    return tuple(map(np.concatenate, zip(*found)))


def _least(ra, rb, cosine: float, limit: float):
    """The cosine that centres must have for a link below them; for points, with no radius, the threshold itself."""
    return np.where((ra == 0) & (rb == 0), cosine, 1.0 - (ra + rb + limit + _SAFE) ** 2 / 2.0)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * cosine, 0.0))


def linked_nodes(a: Tree, b: Tree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes (of ``a``, of ``b``) all of whose points are linked; every linked pair is in exactly one of them.

    For a tree with itself, (n, n) stands for all pairs within n and each other pair comes once.
    """
    limit = math.sqrt(2.0 - 2.0 * cosine)
    same = a is b
    whole_a, whole_b = [np.zeros(0, int)], [np.zeros(0, int)]
    leaf = np.diff(a.first) == 0
    (start_a, count_a, kids_a), (start_b, count_b, kids_b) = a.below(), b.below()
    todo = [(np.zeros(1, int), np.zeros(1, int))]
    while todo:
        i, j = todo.pop()
        if same:
            done = (i == j) & (leaf[i] | (2 * a.radius[i] + _SAFE <= limit))
            whole_a.append(i[done])
            whole_b.append(j[done])
            i, j = i[~done], j[~done]
        size = count_a[i] * count_b[j]
        if not len(i):
            continue
        if len(i) > 1 and size.sum() > PAIRS:
            middle = len(i) // 2
            todo += [(i[:middle], j[:middle]), (i[middle:], j[middle:])]
            continue
        if len(i) == 1 and size[0] > PAIRS:
            p, q = _near(a, kids_a[start_a[i[0]] :][: count_a[i[0]]], b, kids_b[start_b[j[0]] :][: count_b[j[0]]], cosine, limit)
            of = np.zeros(len(p), int)
        else:
            of = np.repeat(np.arange(len(i)), size)
            p, q = np.divmod(np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size), count_b[j][of])
        if same:
            once = (i[of] != j[of]) | (p <= q)
            of, p, q = of[once], p[once], q[once]
        n, m = kids_a[start_a[i][of] + p], kids_b[start_b[j][of] + q]
        least = _least(a.radius[n], b.radius[m], cosine, limit)
        near = np.einsum("ij,ij->i", a.coarse[a.centre[n]], b.coarse[b.centre[m]]) >= least - _NEAR
        n, m, least = n[near], m[near], least[near]
        dots = np.einsum("ij,ij->i", a.x[a.centre[n]], b.x[b.centre[m]])
        near = dots >= least
        n, m, dots = n[near], m[near], dots[near]
        reach = a.radius[n] + b.radius[m]
        sure = (reach == 0) | (_distance(dots) + reach + _SAFE <= limit)
        own = same & (n == m)
        sure = np.where(own, False, sure)
        alone = own & leaf[n] if same else own
        for taken in (sure, alone):
            whole_a.append(n[taken])
            whole_b.append(m[taken])
        further = ~sure & ~alone
        todo.append((n[further], m[further]))
    return np.concatenate(whole_a), np.concatenate(whole_b)


def _may_meet(a: Tree, b: Tree, limit: float) -> bool:
    """Whether the covering radii of two roots leave room for a link."""
    apart = float(_distance(np.array(a.x[a.centre[0]] @ b.x[b.centre[0]])))
    return apart <= a.radius[0] + b.radius[0] + limit + _SAFE


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number in the component of each of ``n`` points."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


def links_of(a: Tree, b: Tree, weight_a: np.ndarray, weight_b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of linked vectors for each point of ``a`` and then ``b``, and edges that span what is linked."""
    same, size = a is b, len(a.x)
    na, nb = linked_nodes(a, b, cosine)
    own = (na == nb) & same
    sums = {id(t): np.concatenate([[0], np.cumsum(w[t.order])]) for t, w in ((a, weight_a), (b, weight_b))}
    counts = []
    for tree, nodes, other, others, keep in ((a, na, b, nb, np.ones(len(na), bool)), (b, nb, a, na, ~own)):
        held = sums[id(other)][other.high[others[keep]]] - sums[id(other)][other.low[others[keep]]]
        change = np.zeros(len(tree.x) + 1, np.int64)
        change += np.bincount(tree.low[nodes[keep]], held, len(change)).astype(np.int64)
        change -= np.bincount(tree.high[nodes[keep]], held, len(change)).astype(np.int64)
        per_point = np.zeros(len(tree.x), np.int64)
        per_point[tree.order] = np.cumsum(change)[:-1]
        counts.append(per_point)
    if same:
        inside = np.zeros(size + 1, np.int64)
        np.add.at(inside, a.low[na[own]], 1)
        np.add.at(inside, a.high[na[own]], -1)
        alone = np.zeros(size, np.int64)
        alone[a.order] = np.cumsum(inside)[:-1]
        total = counts[0] + counts[1] - alone * weight_a  # not a link to itself
    else:
        total = np.concatenate(counts)
    shift = 0 if same else size
    single = (a.high[na] - a.low[na] == 1) & (b.high[nb] - b.low[nb] == 1)
    edges_a, edges_b = [a.order[a.low[na[single]]]], [b.order[b.low[nb[single]]] + shift]
    for n, m in zip(na[~single].tolist(), nb[~single].tolist()):
        left, right = a.order[a.low[n] : a.high[n]], b.order[b.low[m] : b.high[m]] + shift
        edges_a += [left, np.full(len(right), left[0])]
        edges_b += [np.full(len(left), right[0]), right]
    root = roots_of(shift + len(b.x), np.concatenate(edges_a), np.concatenate(edges_b))
    tied = np.flatnonzero(root != np.arange(len(root)))
    return total, tied, root[tied]


def _with_cells(classes: DataFrame, pivots: list[tuple[int, np.ndarray]]) -> DataFrame:
    """``cell``: the nearest pivot of the same vector length; and the distance to it."""
    by_dim: dict[int, tuple[list[int], np.ndarray]] = {}
    for number, (dim, vector) in enumerate(pivots):
        held = by_dim.setdefault(dim, ([], []))
        held[0].append(number)
        held[1].append(vector)
    tables = {d: (np.array(n), np.array(v)) for d, (n, v) in by_dim.items()}
    fields = "cls long, weight long, dim int, vector array<double>, cell int, away double"

    def run(batches):
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("vector"))
                x = x / _norms(x)
                numbers, table = tables[dim]
                dots = x @ table.T
                near = np.argmax(dots, axis=1)
                away = _distance(dots[np.arange(len(x)), near])
                flat = pa.array(x.reshape(-1))
                ends = pa.array(np.arange(len(x) + 1) * dim, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), part.column("weight"), part.column("dim"), pa.ListArray.from_arrays(ends, flat), pa.array(numbers[near], pa.int32()), pa.array(away)],
                    names=["cls", "weight", "dim", "vector", "cell", "away"],
                )

    return classes.mapInArrow(run, fields)


def _norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows; components are scaled first, so that very large or small ones neither overflow nor vanish."""
    top = np.abs(x).max(axis=1, keepdims=True)
    return top * np.sqrt(((x / top) ** 2).sum(axis=1, keepdims=True))


def linked_vectors(vectors: DataFrame, cosine: float = COSINE, id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Defined results: a vector that is null, empty, zero, or holds null or non-finite components links with nothing and is a
    component of its own; so are vectors of different lengths to each other. Rows with one id are vectors of their own;
    a component's id is the smallest id in it, null only if none of its rows has one.
    """
    spark = vectors.sparkSession
    ship(spark)
    good = finite(vector) & F.exists(vector, lambda x: x != 0)
    rows = stored(vectors.select(F.col(id).cast("long").alias("id"), F.when(good, F.col(vector).cast("array<double>")).alias("vector")), "vectors")
    rows = rows.withColumn("cls", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    classes = rows.where("vector IS NOT NULL").groupBy("cls").agg(F.first("vector").alias("vector"), F.count("cls").alias("weight"))
    classes = stored(classes.select("cls", "weight", F.size("vector").alias("dim"), "vector"), "vector-classes")
    total = classes.count()
    if total == 0:
        return rows.select(F.col("id").alias(id), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = max(1, min(MAX_PIVOTS, total // block))
    # a bounded sample: the smallest class hashes of each vector length
    sizes = [r.dim for r in classes.select("dim").distinct().collect()]
    pivots = []
    for dim in sizes:
        for r in classes.where(F.col("dim") == dim).orderBy("cls").limit(wanted).collect():
            x = np.array(r.vector)[None, :]
            pivots.append((dim, (x / _norms(x))[0]))
    cells = stored(_with_cells(classes, pivots), "vector-cells")
    stats = {r.cell: r for r in cells.groupBy("cell").agg(F.max("away").alias("away"), F.count("cls").alias("n")).collect()}
    limit = math.sqrt(2.0 - 2.0 * cosine) + _SAFE
    blocks = {c: max(1, -(-r.n // block)) for c, r in stats.items()}
    # trees are numbered cell by cell, and so many neighbours make a group
    starts, trees_in_all = {}, 0
    for c in sorted(blocks):
        starts[c], trees_in_all = trees_in_all, trees_in_all + blocks[c]
    size = max(1, min(GROUP, -(-trees_in_all // GROUPS)))
    spans = {c: (starts[c] // size, (starts[c] + blocks[c] - 1) // size) for c in blocks}
    pairs = []  # at most MAX_PIVOTS ** 2 / 2 pairs of cells
    for c in sorted(stats):
        for d in sorted(stats):
            if c <= d and pivots[c][0] == pivots[d][0]:
                apart = float(_distance(np.array(pivots[c][1] @ pivots[d][1])))
                if c == d or apart <= stats[c].away + stats[d].away + limit:
                    pairs.append((*spans[c], *spans[d]))
    number = F.create_map(*(F.lit(v) for c, n in blocks.items() for v in (c, n)))
    dealt = cells.withColumn("part", F.pmod(F.hash("cls"), number[F.col("cell")]))

    def planted(key: tuple, group: pa.Table) -> pa.Table:
        x = matrix(group.column("vector"))
        tree = Tree.build(x)
        payload = pack(x=x, cls=np.asarray(group.column("cls")), weight=np.asarray(group.column("weight")), **tree.parts)
        return pa.table({"cell": [key[0].as_py()], "part": [key[1].as_py()], "payload": [payload]}, schema=_TREE)

    trees = stored(dealt.groupBy("cell", "part").applyInArrow(planted, "cell int, part int, payload binary"), "cover-trees")
    start = F.create_map(*(F.lit(v) for c, n in starts.items() for v in (c, n)))
    grouped = trees.withColumn("g", F.floor((start[F.col("cell")] + F.col("part")) / size).cast("int"))
    wide = spark.createDataFrame(sorted(set(pairs)), "c0 int, c1 int, d0 int, d1 int")
    wide = wide.select(F.explode(F.sequence("c0", "c1")).alias("c"), "d0", "d1").select("c", F.explode(F.sequence("d0", "d1")).alias("d"))
    wide = wide.select(F.least("c", "d").alias("c"), F.greatest("c", "d").alias("d")).distinct()
    left = wide.join(grouped.withColumnRenamed("g", "c"), "c").withColumn("side", F.lit(0))
    right = wide.where("c < d").join(grouped.withColumnRenamed("g", "d"), "d").withColumn("side", F.lit(1))
    order = ["c", "d", "side", "cell", "part", "payload"]
    sides = left.select(*order).unionByName(right.select(*order))
    names = ("order", "centre", "radius", "low", "high", "first", "child")

    def compared(key: tuple, group: pa.Table) -> pa.Table:
        held: tuple[list, list] = [], []
        rows_of = zip(*(group.column(c).to_pylist() for c in ("cell", "part", "side", "payload")))
        for cell, part, side, payload in sorted(rows_of, key=lambda r: r[:2]):
            one = unpack(payload)
            held[side].append((one["cls"], one["weight"], Tree(one["x"], **{k: one[k] for k in names})))
        itself = key[0] == key[1]
        counts, ends, roots = [], [], []
        for k, (cls, weight, a) in enumerate(held[0]):
            for other, other_weight, b in held[0][k:] if itself else held[1]:
                if a.x.shape[1] != b.x.shape[1] or not _may_meet(a, b, limit):
                    continue
                count, tied, root = links_of(a, b, weight, other_weight, cosine)
                ids = cls if a is b else np.concatenate([cls, other])
                some = np.flatnonzero(count)
                counts.append((ids[some], count[some]))
                ends.append(ids[tied])
                roots.append(ids[root])
        if not counts:
            return _FOUND.empty_table()
        ids, place = np.unique(np.concatenate([i for i, _ in counts]), return_inverse=True)
        sums = np.zeros(len(ids), np.int64)
        np.add.at(sums, place, np.concatenate([n for _, n in counts]))
        tied, root = np.concatenate(ends), np.concatenate(roots)
        return pa.table(
            [
                np.concatenate([ids, tied]),
                pa.array(np.concatenate([ids, root]), mask=np.arange(len(ids) + len(tied)) < len(ids)),
                np.concatenate([sums, np.zeros(len(tied), np.int64)]),
            ],
            schema=_FOUND,
        )

    found = stored(sides.groupBy("c", "d").applyInArrow(compared, "a long, b long, n long"), "vector-links")
    groups = components(found.where("b IS NOT NULL"))
    counts = found.where("n > 0").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    known = classes.select("cls", "weight").join(counts, "cls", "left").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
    known = known.select("cls", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component"))
    smallest = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("id").alias("least")).join(known, "cls")
    named = smallest.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(named, "component").drop("component")
    out = rows.select("id", "cls").join(known, "cls", "left")
    return out.select(
        F.col("id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.coalesce("component_id", "id").isNull()).alias("kept"),
    )


_TREE = pa.schema([("cell", pa.int32()), ("part", pa.int32()), ("payload", pa.binary())])
_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
