"""Ids and texts against the sentencepiece library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pagesift.llm import chunk_table, pieces
from pagesift.llm.queries import PIECES, op11_sentencepiece_round_trip

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
ODD = ["", " ", "  ", "a", " a", "a ", "▁a▁ b", "x▁", "<s></s><unk>", "<0x41>", "\n\n x\t", "   " * 30, "é中😀𐍈\x00x", "ab" * 500,
       " " * 1000 + "x" + " " * 333, "a" * 40, "퟿￿", "1234 56 7  8", "word " * 3000, "unbroken" * 2000]


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(pieces.piece_arrays(PIECES))


def test_odd_texts(own):
    for text, ids in zip(ODD, own.encode(ODD)):
        assert ids.tolist() == LIBRARY.encode(text), text[:40]
        assert own.decode(np.append(ids, 2)) == LIBRARY.decode([*ids.tolist(), 2])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aestinor '\n\t.,!é中😀▁<0x>12"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=5))
def test_any_texts(own, texts):
    for text, ids in zip(texts, own.encode(texts)):
        assert ids.tolist() == LIBRARY.encode(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([1, 2, 5, 200, 231, 187, 176, 35, 300, 29871, 13, 260, 259]), max_size=9))
def test_any_ids(own, ids):
    assert own.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids)


def test_long_words_by_heap_as_short_ones(own, monkeypatch):
    words = [b" " + w.encode() for w in ("internationalization", "aaaaaaaaaaaaaaaa", "thethethe", "xé中y", "")]
    short = own.segment(words)
    monkeypatch.setattr(pieces, "LONG", 1)
    long = own.segment(words)
    assert short[0].tolist() == long[0].tolist() and short[1].tolist() == long[1].tolist()


def test_other_models_are_refused():
    with pytest.raises(Exception):
        pieces.piece_arrays(public_tokenizers.path("byte_bpe_50k.json"))


def test_round_trip_query(spark, testdata):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").collect()}
    rows = op11_sentencepiece_round_trip(spark, f"{testdata}/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = [*LIBRARY.encode(texts[r.doc_id]), 2]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("block, bucket", [(50, 7), (12_000_000, 1_000_000)])
def test_odd_rows_in_blocks(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(chunk_table, "BLOCK", block)
    monkeypatch.setattr(chunk_table, "BUCKET", bucket)
    rows = [(k, t, "x", "y") for k, t in enumerate(ODD)] + [(50, None, "x", None), (None, "no id", "x", "y"), (3, "again", None, "y"), (3, "again", None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, block string").repartition(3)
    got = chunk_table.with_ids(docs, PIECES, keep=("doc_id", "ids", "block"), decoded=True)
    want = sorted((str(a), [*LIBRARY.encode(t or ""), 2], LIBRARY.decode(LIBRARY.encode(t or "")), str(b)) for a, t, _, b in rows)
    assert sorted((str(r.doc_id), r.ids, r.decoded, str(r.block)) for r in got.collect()) == want
    back = chunk_table.with_text(got.select("doc_id", "ids"), PIECES).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((a, d) for a, _, d, _ in want)
    assert chunk_table.with_ids(docs.where("false"), PIECES).count() == 0


def test_numbers_go_through_no_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c")], "doc_id long, text string")
    plan = chunk_table.with_ids(docs, PIECES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(block") == 1 and "codes" not in plan.split("Exchange")[-1].split("\n")[0]
