"""Passages of words against a brute-force comparison of all places."""

import random

import corpus_pipeline
from pagesift.llm import lines


def brute(rows, least=lines.PASSAGE):
    """Words that stay of every row: those that no run of ``least`` words with an earlier place covers."""
    first, runs = {}, []
    for d, t in sorted((d, t) for d, t in rows if t):
        words = t.split()
        for i in range(len(words) - least + 1):
            run = tuple(words[i : i + least])
            runs.append((d, i, first.setdefault(run, (d, i))))
    gone = {}
    for d, i, place in runs:
        if place < (d, i):
            gone.setdefault(d, set()).update(range(i, i + least))
    return {d: None if t is None else [w for k, w in enumerate(t.split()) if k not in gone.get(d, ())] for d, t in rows}


def made_rows():
    rng = random.Random(4)
    pool = [f"w{k}" for k in range(400)]

    def words(n):
        return rng.choices(pool, k=n)

    passages = [words(n) for n in (49, 50, 51, 52, 60, 90, 200)]
    rows = [(0, None), (1, ""), (2, "z " * 130), (3, " \t\n"), (4, "short")]
    for k in range(5, 90):
        parts = []
        for _ in range(rng.randint(1, 3)):
            part = list(rng.choice(passages))
            if rng.random() < 0.3:  # edited in one word
                part[rng.randrange(len(part))] = "edited"
            parts += words(rng.randint(0, 60)) + part
        rows.append((k, "".join(w + rng.choice([" ", " ", " ", "\n", "\t", "  "]) for w in parts + words(rng.randint(0, 5)))))
    return rows


def test_against_all_places(spark):
    rows = made_rows()
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in lines.without_passages(df).collect()}
    want = brute(rows)
    assert {d: None if r.text is None else r.text.split() for d, r in got.items()} == want
    assert all(got[d].n_words_removed == len(t.split()) - len(want[d]) for d, t in rows if t and t.strip())
    assert all(got[d].text == t for d, t in rows if not got[d].n_words_removed)
    assert all(r.n_chars == len(r.text or "") for r in got.values())
    assert lines.without_passages(df.where("false")).count() == 0


def test_pipeline_stage_cuts_passages_in_mid_line(spark, testdata):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"first {passage} tail of it", "x"), (2, f"another start {passage}\nnext line", "x"), (3, passage.replace("p30 ", "new ") + " end", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, hash string")
    got = {r.doc_id: r.text for r in corpus_pipeline.without_repeated_lines(spark, df, f"{testdata}/sf0.001").collect()}
    assert got == {1: rows[0][1], 2: "another start \nnext line", 3: rows[2][1]}


def test_no_passage_is_left_in_the_table(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.without_repeated_lines(spark, docs, f"{testdata}/sf0.001").collect()]
    assert all(len(words) == len(text.split()) for (d, text), words in zip(rows, brute(rows).values()))
