"""What a worker holds at once: it follows the chunk, not the batch of texts or the number of words met."""

import os
import random
import tracemalloc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import pytest

from pagesift.llm import bpe, encoding, jaccard, packing
from pagesift.llm.queries import TOKENIZER

MB = 1 << 20


def most(run):
    """MB that ``run`` held at most and in the end, beyond what was there before it."""
    tracemalloc.start()
    try:
        run()
        now, peak = tracemalloc.get_traced_memory()
        return peak / MB, now / MB
    finally:
        tracemalloc.stop()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(20_000)]
    return [" ".join(rng.choices(words, k=350)) for _ in range(2_000)]


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.compile_encoder(TOKENIZER, [" the", " of"]))


def test_encoding_holds_one_chunk(encoder, texts):
    bpe.character_classes()
    bpe._powers(1_000)

    def run():
        for ids in encoder.encode(texts):
            assert len(ids)

    assert sum(map(len, texts)) > 3_000_000
    assert most(run)[0] < 35


def test_rare_words_are_forgotten_beside_a_lexicon(texts):
    own = bpe.Encoder(bpe.compile_encoder(TOKENIZER, [" the", " of"]))
    for k in range(0, 200_000, 20_000):
        next(own.encode([" ".join(f"w{n:x}q" for n in range(k, k + 20_000))]))
        assert len(own.known) <= bpe.BESIDE_LEXICON < 200_000


def test_shingles_hold_one_chunk(texts):
    bpe._powers_cached.cache_clear()

    def run():
        for s in jaccard.shingle_sets(texts, 5):
            assert len(s) == 346

    peak, rest = most(run)
    assert peak < 40 and rest < 10


def test_chunks_do_not_change_results(encoder, texts, monkeypatch):
    few = texts[:60]
    ids = [x.tolist() for x in encoder.encode(few)]
    sets = [x.tolist() for x in jaccard.shingle_sets(few, 5)]
    for size in (1, 5_000, 2_000_000):
        monkeypatch.setattr(bpe, "CHUNK", size)
        monkeypatch.setattr(jaccard, "CHUNK", size)
        assert [x.tolist() for x in encoder.encode(few)] == ids
        assert [x.tolist() for x in jaccard.shingle_sets(few, 5)] == sets


def test_packing_takes_few_texts_at_once(spark, monkeypatch):
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    documents = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string").coalesce(1)
    name = encoding.send_encoder(spark, documents, TOKENIZER)
    written = packing.arrow_rows

    def seen(session, rows):
        before.append(rows)
        return written(session, rows)

    monkeypatch.setattr(packing, "arrow_rows", seen)
    monkeypatch.setattr(packing, "TEXTS", 7)
    held = spark.conf.get(key)
    assert packing.packed(documents, name).select("doc_id").distinct().count() == 50
    assert before == [7] and spark.conf.get(key) == held
