"""Links and nearest vectors against plain matrix products."""

import numpy as np
import pytest
from oracle import connect, difference

from pagesift.llm import cover_tree, segment_search
from pagesift.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["op2_embedding_near_dedup", "op3_exact_top_k"])
@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query(spark, testdata, name, sf):
    if sf == "sf0.1" and name.startswith("op2"):
        rows = QUERIES[name](spark, f"{testdata}/{sf}").collect()
        vectors = spark.read.parquet(f"{testdata}/{sf}/embeddings.parquet").collect()
        check_links([(r.vec_id, r.embedding) for r in vectors], rows)
        return
    assert difference(QUERIES[name](spark, f"{testdata}/{sf}"), connect(f"{testdata}/{sf}"), ORACLES[name]) is None


def check_links(vectors, rows, cosine=0.95):
    good = [k for k, (_, v) in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = [np.array(vectors[k][1], np.float64) for k in good]
    x = [v / np.abs(v).max() for v in x]
    linked = {k: [] for k in range(len(vectors))}
    for a, i in enumerate(good):
        for b, j in enumerate(good):
            if a != b and len(x[a]) == len(x[b]) and x[a] @ x[b] / (np.linalg.norm(x[a]) * np.linalg.norm(x[b])) >= cosine:
                linked[i].append(j)
    want = []
    for k, (vec_id, _) in enumerate(vectors):
        seen, todo = {k}, [k]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        named = [vectors[j][0] for j in seen if vectors[j][0] is not None]
        least = min(named) if named else None
        want.append((vec_id, len(linked[k]), least, True if least is None else vec_id == least if vec_id is not None else False))
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)


def odd_vectors(seed=4):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, 6))
    rows = [(k, (base[rng.integers(12)] * rng.uniform(0.1, 9) + rng.normal(size=6) * rng.choice([0, 0.05, 0.3])).tolist()) for k in range(260)]
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (304, [float("nan")] + [1.0] * 5), (305, [float("inf")] * 6),
             (306, [1.0, 2.0]), (307, [2.0, 4.0]), (5, rows[9][1]), (5, rows[5][1]), (310, [1e30] * 6), (311, [2e30] * 6), (312, [1e-30] * 6)]
    rows += [(400 + k, rows[0][1]) for k in range(40)]
    return rows


@pytest.mark.parametrize("block", [16, 2048])
def test_odd_vectors(spark, block):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cls string")
    check_links(rows, cover_tree.linked_vectors(df, block=block).collect())


def test_near_copies_and_rows_without_id(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=32)
    rows = [(k, (centre + rng.normal(size=32) * 0.08).tolist()) for k in range(400)] + [(None, centre.tolist()), (None, (-centre).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_links(rows, cover_tree.linked_vectors(df, block=64).collect())


def test_tree_keeps_its_promises():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    x[200:] = x[:100] + rng.normal(size=(100, 5)) * 0.01
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = cover_tree.Tree.build(x)
    for node in range(len(t.centre)):
        points = t.order[t.low[node] : t.high[node]]
        away = np.linalg.norm(x[points] - x[t.centre[node]], axis=1)
        assert away.max() <= t.radius[node] + 1e-7 and t.centre[node] in points
        children = t.child[t.first[node] : t.first[node + 1]]
        if len(children):
            assert t.centre[children[0]] == t.centre[node]  # nested
            assert sum(t.high[c] - t.low[c] for c in children) == len(points)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cover_tree.linked_vectors(df).count() == 0
    assert segment_search.top_k(df, F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("block", [(8, 16), (1024, 8192)])
def test_top_k_of_odd_vectors(spark, block):
    rows = [(None if i == 7 else i, v) for i, v in odd_vectors()]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, row int")
    got = segment_search.top_k(df, F.col("vec_id") % 10 == 0, query_block=block[0], block=block[1]).collect()
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    limit, want = 2**63 - 1, []
    for k, (i, q) in enumerate(good):
        if i % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for m, (j, c) in enumerate(good) if m != k and len(c) == len(q))[:10]
            want += [(i, n + 1, j, max(-limit, min(limit, -s))) for n, (s, j) in enumerate(scored)]
    # rows with one id and one score may come in either order
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_bounds_hold():
    rng = np.random.default_rng(8)
    q, c = np.floor(rng.normal(size=(20, 37)) * 900), np.floor(rng.normal(size=(50, 37)) * 900)
    exact = q @ c.T
    for segments in (1, 4, 16, 64):
        bound = segment_search.upper_bounds(segment_search.statistics(q, segments), segment_search.statistics(c, segments))
        assert (bound >= exact - 1e-6).all()


@pytest.mark.parametrize("block", [4, 64])
def test_scores_beyond_a_long_are_ranked_exactly(spark, block):
    rows = [(k, [1e20 * (k + 1), -1.0]) for k in range(19)] + [(50 + k, [-1e20 * (k + 1), 3.0]) for k in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = segment_search.top_k(df, F.col("vec_id").isin(0, 50), k=2, query_block=4, block=block).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 18), (0, 2, 17), (50, 1, 54), (50, 2, 53)]


def test_order_keys_are_in_the_order_of_the_scores():
    scores = [s * v for s in (-1, 1) for v in (2**63, 2**63 + 1, 2**64, 2**71 + 5, 2**72, 10**40)]
    assert sorted(scores) == sorted(scores, key=segment_search.order_key)
    assert segment_search.order_key(2**63 - 2) is None
