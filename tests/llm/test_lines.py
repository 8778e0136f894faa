"""Line runs against a brute-force comparison of all places."""

import random

import pytest

from pagesift.llm import lines
from pagesift.llm.queries import op9_line_dedup


def brute(rows, least):
    """A line goes if some run of ``least`` words around it occurs at an earlier place."""
    docs = sorted({(lines.LAST_ID if d is None else d, t) for d, t in rows if t})
    order = {}
    seqs = []
    for d, t in docs:
        full = [(k, x.strip(" "), x.strip(" ").count(" ") + 1) for k, x in enumerate(t.split("\n")) if x.strip(" ")]
        seqs.append(((d, t), full))
    first = {}
    runs = []
    for key, full in seqs:
        for i in range(len(full)):
            words = 0
            for j in range(i, min(i + least, len(full))):
                words += full[j][2]
                if words >= least:
                    content = tuple(x[1] for x in full[i : j + 1])
                    runs.append((key, i, j, content))
                    first.setdefault(content, set()).add((key, i))
    gone = {}
    for key, i, j, content in runs:
        # the order between documents of one id is that of the text's hash, so such places are not compared here
        if any(k[0] < key[0] or (k == key and a < i) for k, a in first[content]):
            full = dict(seqs)[key]
            after = [*(x[0] for x in full), key[1].count("\n") + 1]
            gone.setdefault(key, set()).update(y for x in range(i, j + 1) for y in range(after[x], after[x + 1]))
    out = []
    for d, t in rows:
        cut = gone.get((lines.LAST_ID if d is None else d, t), set())
        out.append((d, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut)))
    return out


def made_rows(seed):
    rng = random.Random(seed)
    pool = ["a b c", "d", "", "e f", "g h i j k l m n o", "p q r s t u v w", "  x y ", "z " * 30 + "z"]
    shared = ["one two three four", "five", "six seven eight nine ten"]
    rows = []
    for k in range(60):
        body = rng.choices(pool, k=rng.randint(0, 9))
        if rng.random() < 0.4:
            at = rng.randint(0, len(body))
            body[at:at] = shared
        rows.append((k, "\n".join(body)))
    return [*rows, (70, None), (71, ""), (None, "p q r s t u v w\nnew"), (72, "d\n" * 40), (5, rows[5][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_places(spark, seed):
    rows = made_rows(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, hash string")
    got = lines.without_repeats(df)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(brute(rows, lines.MIN_WORDS), key=str)
    assert "hash" in got.columns


def test_run_found_beside_another_first_place(spark):
    run = ["g h i j k l m n o", "tail", "p q r s t u v w"]
    rows = [(1, "\n".join(run[:1])), (2, "\n".join(run[2:])), (3, "\n".join(["x", *run, "y"])), (4, "\n".join(["u", *run, "v"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in lines.without_repeats(df).collect()}
    assert got[4] == ("u\nv", 5, 3)
    assert got[3] == ("x\ntail\ny", 5, 2)


def test_query_and_empty_table(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = op9_line_dedup(spark, f"{testdata}/sf0.001").collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(brute(rows, lines.MIN_WORDS))
    assert lines.without_repeats(docs.where("false")).count() == 0
