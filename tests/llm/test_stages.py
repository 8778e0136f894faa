"""Stages carry any other columns of the documents along, whatever their names."""

import pytest

import corpus_pipeline

HELPERS = ["kept", "quality_score", "n_lines", "n_removed", "spans", "_doc", "_hash", "_keep", "_pieces", "n_words_removed", "_component", "_blank",
           "_text", "_base", "secret_spans", "_ratios", "_starts", "cls", "n", "key", "lang", "n_chars"]


@pytest.fixture(scope="module")
def documents(spark):
    prose = "The old house stood on a hill above the river, and every evening its windows caught the last light. Nobody had lived there for years."
    texts = [prose, prose + " But the garden was still tended.", None, "", "password = hunter2secret99 " + prose[::-1], prose * 3]
    rows = [(k, t, *[f"{c}-{k}" for c in HELPERS]) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in HELPERS)).drop("n_chars")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_other_columns_come_out_as_they_were(spark, documents, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, documents, "")
    assert out.columns == documents.columns
    rows = out.collect()
    assert rows
    for r in rows:
        for c in documents.columns[2:]:
            assert r[c] == f"{c}-{r.doc_id}"


def test_last_stage_does_not_mind_them(spark, documents):
    assert dict(corpus_pipeline.STAGES)["packing"](spark, documents, "").count() == 6


def test_folders_of_earlier_stages_go(spark, documents, tmp_path):
    import os

    first = corpus_pipeline.without_near_copies(spark, documents, "")
    folder = corpus_pipeline._BEFORE[spark.sparkContext.applicationId]
    second = corpus_pipeline.without_near_copies(spark, first, "")  # still reads the first one's tables
    assert second.count() and os.path.exists(folder.removeprefix("file:"))
    folder = corpus_pipeline._BEFORE[spark.sparkContext.applicationId]
    second.write.parquet(str(tmp_path / "out"))
    assert corpus_pipeline.without_near_copies(spark, spark.read.parquet(str(tmp_path / "out")), "").count()
    assert not os.path.exists(folder.removeprefix("file:"))
