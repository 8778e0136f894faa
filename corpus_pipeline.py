"""Documents to packed training sequences: quality, repeated lines, near copies, secrets, packing.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.llm import encoding, jaccard, lines, packing, quality, secret_scan
from pagesift.llm.common import drop, new_dir, scratch, stored
from pagesift.llm.queries import TOKENIZER


class _Carried:
    """Documents as ``doc_id, text, n_chars`` beside one column that holds all the others of the caller's row.

    That column's name is made up anew, so no column of the caller can meet one that a stage uses; all of them come out
    as they were, but for the text and, where there is such a column, its length.
    """

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.name = f"_row_{uuid.uuid4().hex[:8]}"
        self.own = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
        others = [c for c in docs.columns if c not in self.own]
        self.docs = docs.select((F.struct(*others) if others else F.lit(None)).alias(self.name), *self.own)

    def rows(self, found: DataFrame) -> DataFrame:
        return found.select(*[F.col(c) if c in self.own else F.col(self.name)[c].alias(c) for c in self.columns])


_BEFORE: dict[str, str] = {}


def _stage(function):
    """A stage whose own tables lie in a folder of their own; that of the stage before it goes, once its rows have been
    written: a folder that ``docs`` itself still reads from stays."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        before = _BEFORE.pop(app, None)
        if before and not any(before in f for f in docs.inputFiles()):
            drop(spark, before)
        with scratch(spark, function.__name__) as folder:
            _BEFORE[app] = folder
            return function(spark, docs, sf_dir)

    return run


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    carried = _Carried(docs)
    return carried.rows(quality.with_quality(carried.docs, quality.train(docs.select("doc_id", "text"))).where("kept"))


@_stage
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repetitions of runs of lines go, then those of passages of words wherever they begin; so does a document of
    which nothing but white space is left by that."""
    carried = _Carried(docs)
    with scratch(spark, "line-runs") as folder:
        cut = lines.without_repeats(carried.docs)
    cut = stored(cut, "line-dedup")
    drop(spark, folder)
    cut = lines.without_passages(cut)
    emptied = (F.col("n_removed") + F.col("n_words_removed") > 0) & ~F.regexp_like("text", F.lit(r"\S"))
    return carried.rows(cut.where(~F.coalesce(emptied, F.lit(False))))


@_stage
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, similarity 0.8)."""
    return jaccard.one_of_each(docs, jaccard.Similarity(words=5, share=80))


@_stage
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    carried = _Carried(docs)
    return carried.rows(secret_scan.redacted(carried.docs, secret_scan.train(docs.select("doc_id", "text"))))


@_stage
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1,024 ids."""
    docs = docs.select("doc_id", "text")
    return packing.packed(docs, encoding.send_encoder(spark, docs, TOKENIZER))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed_sequences),
]

# Expectation-maximisation, trained scorers and best fit have no SQL form; tests/llm compares stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
