"""What line dedup and the near-copy join move: only documents that may repeat, and no parts that agree by chance."""

import os

import numpy as np
from pyspark.sql import functions as F

from pagesift.llm import jaccard, lines
from pagesift.llm.common import met_and_others, scratch


def test_unrelated_sets_share_no_key():
    rng = np.random.default_rng(5)
    how, seen = jaccard.Similarity(), set()
    for n in [*range(64, 1_000, 9), 256, 512]:  # in the smallest of a band many parts are empty
        keys = jaccard.part_keys(np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)), how).tolist()
        assert keys and not seen & set(keys)
        seen |= set(keys)


def test_sets_at_the_bound_share_a_key():
    rng = np.random.default_rng(6)
    for share in (80, 90):
        how = jaccard.Similarity(3, share)
        for n in range(2, 700, 3):
            most = how.differing(n + n * how.of // how.share)
            x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            for gone in {0, most // 2, most}:
                y = np.unique(np.concatenate([x[gone:], rng.integers(0, 2**63, most - gone, dtype=np.uint64)]))
                if len(y) and how.linked(len(np.intersect1d(x, y)), len(x) + len(y)) and jaccard.class_of(x) != jaccard.class_of(y):
                    assert set(jaccard.part_keys(x, how).tolist()) & set(jaccard.part_keys(y, how).tolist())


def test_only_rows_that_may_meet_take_a_join(spark):
    rows = spark.range(2_000).select((F.col("id") % 1_900).alias("a"), F.lit("x").alias("b"), "id")
    wanted = rows.where("a % 100 = 7").select("a", "b")
    met, others = met_and_others(rows, wanted, ["a", "b"])
    assert met.columns == others.columns == rows.columns
    assert sorted(r.id for r in met.collect()) == [k for k in range(2_000) if k % 1_900 % 100 == 7]
    assert sorted(r.id for r in others.collect()) == [k for k in range(2_000) if k % 1_900 % 100 != 7]
    met, others = met_and_others(rows, wanted.where("false"), ["a", "b"])
    assert met.count() == 0 and others.count() == 2_000


def test_tables_of_a_step_go_before_texts_are_joined(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"{passage}\nend", 3), (2, f"start\n{passage}", 4), (None, None, 0), (4, "alone", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    with scratch(spark, "steps") as folder:
        found = [lines.without_repeats(df), lines.without_passages(df)]
    written = [os.path.basename(d) for d, _, files in os.walk(folder.removeprefix("file:")) if any(f.endswith(".parquet") for f in files)]
    assert written and {name.rsplit("-", 1)[0] for name in written} <= {"line-spans", "print-places", "later-runs"}
    assert [r.text for r in found[0].orderBy("doc_id").collect()] == [None, rows[0][1], "start", "alone"]
    assert [(r.text, r.n_words_removed, r.n_chars) for r in found[1].orderBy("doc_id").collect()] == [(None, 0, 0), (rows[0][1], 0, 3), ("start\n", 60, 6), ("alone", 0, 5)]
