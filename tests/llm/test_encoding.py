"""Ids against the tokenizers library, the way back, and the packing."""

import hashlib
import os
import random
import zlib

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagesift.llm import bpe, encoding, packing
from pagesift.llm.lexicon import compile_lexicon, look_up
from pagesift.llm.queries import TOKENIZER, op4_best_fit_packing, op10_bpe_round_trip

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", "a", " ", "  ", "\n", "a\n", "\n\n a", "I'll  don't 's's !'s  's\n's we'rex 'tabc '", "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "éèçß 中文字 😀😀   x 　",
       "a" * 350, "12 345a6.7!!??...", "\x00\x01a\x00", "\r\n\t\tq", "ab" * 500 + " " * 40 + "z", "ſſ ǅ Ⅷ ½ ²³", "áb‍", "'re've'll'd'm's't", "''s '' 's", " '\n'd", "the quick " * 9]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.compile_encoder(TOKENIZER, ["the", " the", " quick", "é", " 's", "\n\n"]))


def test_odd_texts(encoder):
    for text, ids in zip(ODD, encoder.encode(ODD)):
        assert ids.tolist() == library_ids(text), text
        assert encoder.decode_bytes(ids).decode() == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aest '\n\t.,!’é中😀"), st.characters(exclude_categories=["Cs", "Cn"])), max_size=40), min_size=1, max_size=5))
def test_any_texts(encoder, texts):
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library_ids(text)


def test_long_word_by_heap(encoder):
    rng = random.Random(3)
    word = "".join(rng.choices("abcdethion", k=3000))
    data = np.frombuffer(word.encode(), np.uint8)
    assert encoder.merge_long(data) == library_ids(word)


def test_forgetting_keeps_ids(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    texts = [f"w{k}xyz zq{k}" for k in range(20)]
    for text in texts:
        assert next(encoder.encode([text])).tolist() == library_ids(text)


def test_lexicon_places():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("abcd", k=rng.randint(1, 7))).encode() for _ in range(700)})
    table = compile_lexicon(words)
    asked = words + [b"e", b"abcdabcdabcd", words[0] + b"z"]
    data = np.frombuffer(b"".join(asked), np.uint8)
    lengths = np.array([len(w) for w in asked])
    places = look_up(table, data, np.cumsum(lengths) - lengths, lengths)
    known = set(words)
    assert places.tolist() == [words.index(w) if w in known else -1 for w in asked]
    assert len(table["base"]) < sum(map(len, words)) / 2  # ends are shared


def test_round_trip_query(spark, testdata):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").collect()}
    rows = op10_bpe_round_trip(spark, f"{testdata}/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def odd_documents(spark):
    rows = [(k, t, "x") for k, t in enumerate(ODD)] + [(50, None, "x"), (None, "no id", "x"), (3, "again", "x"), (3, "again", "x"), (60, "word " * 3000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


def test_ids_and_text_of_odd_rows(spark):
    docs = odd_documents(spark)
    name = encoding.send_encoder(spark, docs, TOKENIZER)
    encoded = encoding.with_ids(docs, name)
    got = sorted((str(r.doc_id), r.ids) for r in encoded.collect())
    assert got == sorted((str(r.doc_id), library_ids(r.text or "")) for r in docs.collect())
    back = sorted((str(r.doc_id), r.decoded) for r in encoding.with_text(encoded, name).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert encoding.with_ids(docs.where("false"), encoding.send_encoder(spark, docs.where("false"), TOKENIZER)).count() == 0


def check_packing(rows, texts, capacity=1024):
    """Every id exactly once, pieces in order, sequences gapless; returns the number of sequences."""
    want = []
    for doc_id, text in texts:
        ids = [*library_ids(text or ""), 2]
        first = len(ids) % capacity if len(ids) > capacity else len(ids)
        cuts = ([0] if first else []) + list(range(first, len(ids), capacity))
        for piece, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)])):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences)


def test_packing_query(spark, testdata):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{testdata}/sf0.01/documents.parquet").collect()]
    rows = op4_best_fit_packing(spark, f"{testdata}/sf0.01").collect()
    n = check_packing(rows, docs)
    assert n <= 1.01 * -(-sum(r.length for r in rows) // 1024)


def test_packing_of_odd_rows_in_rounds(spark):
    docs = odd_documents(spark).repartition(7)
    name = encoding.send_encoder(spark, docs, TOKENIZER)
    rows = packing.packed(docs, name, group=3, slack=0).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert packing.packed(docs.where("false"), name).count() == 0


def test_bins_that_cannot_be_paired_end_the_rounds(spark):
    docs = spark.createDataFrame([(k, "word " * 600) for k in range(64)], "doc_id long, text string").repartition(16)
    name = encoding.send_encoder(spark, docs, TOKENIZER)
    rows = packing.packed(docs, name, group=4).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()]) == 64


def test_best_fit_is_tight():
    bins = packing.best_fit(np.array([5, 5, 5, 3, 2, 7, 8, 2, 1, 2]), 10)
    assert len(bins) == 4
    assert sorted(k for b in bins for k in b) == list(range(10))
