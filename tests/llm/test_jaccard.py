"""Near copies against all pairs of shingle sets."""

import random
import re

import numpy as np
import pytest
from oracle import connect, difference

from pagesift.llm import jaccard
from pagesift.llm.queries import ORACLES, op7_jaccard_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w)} if len(w) < words else {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}


def brute(rows, how):
    """Component and size of every row; rows with one id are one document."""
    sets = [shingles(t, how.words) for _, t in rows]
    near = {k: set() for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0]
            if sets[a] and sets[b] and (same or how.of * len(sets[a] & sets[b]) >= how.share * len(sets[a] | sets[b])):
                near[a].add(b)
                near[b].add(a)
    out = []
    for k, (doc_id, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=str)


def made_rows(seed, copies=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    line = " ".join(rng.choices(vocabulary, k=14))
    bases = [rng.choices(vocabulary, k=n) for n in (8, 12, 30, 31, 64, 120, 130, 250, 700)]
    rows = []
    for k in range(copies * 4):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            at = rng.randrange(len(words))
            words[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)]
        text = " ".join(words)
        if rng.random() < 0.4:
            text = f"{line}\n{text}"
        rows.append((k, text if rng.random() < 0.9 else text.upper()))
    rows += [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one two three"), (907, "one  two\nthree"), (3, rows[40][1]),
             (None, rows[7][1]), (None, "lonely words without an id"), (950, "é à" * 50), (951, "long " * 30_000)]
    return rows


@pytest.mark.parametrize("how", [jaccard.Similarity(3, 90), jaccard.Similarity(5, 80)])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, how, seed):
    rows = made_rows(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cls string, n int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked_documents(df, how).collect()), key=str)
    assert got == brute(rows, how)


def test_small_squares(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    rows, how = made_rows(6), jaccard.Similarity(3, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.linked_documents(df, how).collect()), key=str)
    assert got == brute(rows, how)


def test_query(spark, testdata):
    assert difference(op7_jaccard_join(spark, f"{testdata}/sf0.01"), connect(f"{testdata}/sf0.01"), ORACLES["op7_jaccard_join"]) is None


@pytest.mark.parametrize("across", [False, True])
def test_forest_joins_what_all_pairs_join(across):
    rng, how = np.random.default_rng(8), jaccard.Similarity(3, 80)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.where(rng.random(60) < p, rng.integers(0, 2**63, 60, dtype=np.uint64), base)) for p in rng.uniform(0, 0.2, 80)]
    rows = {"n": list(map(len, sets)), "comp": [k % 70 for k in range(80)], "part": [k % 2 for k in range(80)], "cls": list(range(80)),
            "bits": [jaccard.signature(s) for s in sets], "i": [0] * 80, "j": [int(across)] * 80}
    square = jaccard._Square(rows, how)

    def groups(pairs):
        name = [k % 70 for k in range(80)]
        for a, b in zip(*pairs):
            name = [min(name[a], name[b]) if x in (name[a], name[b]) else x for x in name]
        return name

    assert 0 < len(square.forest()[0]) < len(set(rows["comp"])) < len(square.every_pair()[0])
    assert groups(square.forest()) == groups(square.every_pair())


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    for share in (80, 90):
        how = jaccard.Similarity(3, share)
        for _ in range(300):
            n = int(rng.integers(4, 600))
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            apart = how.differing(2 * len(x))
            gone = int(rng.integers(0, apart + 1))
            y = np.unique(np.concatenate([x[gone:], rng.integers(0, 2**63, max(0, int(rng.integers(0, apart - gone + 1))), dtype=np.uint64)]))
            if len(y) and how.linked(len(np.intersect1d(x, y)), len(x) + len(y)) and jaccard.class_of(x) != jaccard.class_of(y):
                assert set(jaccard.part_keys(x, how).tolist()) & set(jaccard.part_keys(y, how).tolist())


def test_one_of_each(spark):
    rows = [(5, "a b c d e f g h"), (2, "A b c d e f g h"), (9, "x"), (9, "x"), (7, ""), (8, None), (None, "a b c d e f g h")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string")
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted([("2", "A b c d e f g h"), ("9", "x"), ("7", ""), ("8", "None")])


def test_one_of_each_links_rows_not_ids(spark):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (1, "red green blue black white grey"),
            (None, "sun moon star sky cloud rain"), (None, "sun moon star sky cloud rain"), (4, None), (4, None), (4, " ")]
    df = spark.createDataFrame([(*r, "c", "b") for r in rows], "doc_id long, text string, _component string, _blank string")
    got = sorted((str(r.doc_id), str(r.text), r._component, r._blank) for r in jaccard.one_of_each(df).collect())
    assert got == sorted((str(a), str(b), "c", "b") for a, b in [*rows[:4], *rows[5:]])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.linked_documents(df).count() == 0
    assert jaccard.one_of_each(df).count() == 0
