"""Token groups and links against plain loops over the libraries' ids."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagesift.llm import alignment, bpe
from pagesift.llm.queries import PIECES, TOKENIZER, op13_token_alignment

A = Tokenizer.from_file(TOKENIZER)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LETTERS = bpe.byte_letters()
ODD = ["", " ", "  a", "a ", "x▁y", "▁", "<s></s> <|endoftext|>", "<|endoftext|>", "<0x41>", "\n\n x\t", "   " * 30, "é中😀𐍈\x00x", "ab" * 500, "word " * 3000, "naïve 中文 text"]


def tokens(text):
    """Ids and bytes of both sides, or nothing where they do not spell the text."""
    if not text:
        return [], []
    a = [(k, bytes(LETTERS[c] for c in A.id_to_token(k))) for k in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(k, bytes([int(B.id_to_piece(k)[3:5], 16)]) if B.is_byte(k) else B.id_to_piece(k).replace("▁", " ").encode()) for k in B.encode(text)]
    raw = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])


def spans(side):
    out, at = [], 0
    for k, x in side:
        out.append((k, at, at + len(x)))
        at += len(x)
    return out


def plain(texts):
    """Rows of the contract by loops over spans."""
    both = [tuple(map(spans, tokens(t))) for t in texts]
    found = []
    for a, b in both:
        of, j = [], 0
        for k, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            m = j
            while m < len(b) and b[m][1] < e:
                of.append((k, b[m][0]))
                m += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, last = [], 0
        for c in cuts:
            groups.append("|".join(",".join(str(k) for k, s, e in side if last <= s and e <= c) for side in (a, b)))
            last = c
        found.append((len(a), len(b), groups, of))
    counts = Counter(p for _, _, _, of in found for p in set(of))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    return [(n, m, len(g), len(of), sum(counts[p] == best[p[0]] for p in of), sum(counts[p] for p in of), ";".join(g)) for n, m, g, of in found]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), min_size=1, max_size=30))
def test_labels_are_the_common_cuts(sizes):
    first = np.cumsum([a for a, _ in sizes])
    second = np.unique(np.append(np.cumsum([b for _, b in sizes])[np.cumsum([b for _, b in sizes]) < first[-1]], first[-1]))
    a, b = alignment.group_labels(first, second)
    cuts = np.intersect1d(first, second)
    assert first[a].tolist() == cuts[np.searchsorted(cuts, first)].tolist()
    assert first[b].tolist() == cuts[np.searchsorted(cuts, second)].tolist()


def test_query(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").collect()
    want = {d.doc_id: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "") for d, w in zip(docs, plain([d.text for d in docs]))}
    got = op13_token_alignment(spark, f"{testdata}/sf0.001").collect()
    assert len(got) == len(want)
    assert {r.doc_id: (*(r[c] for c in COLUMNS), r.groups_sha256) for r in got} == want


@pytest.mark.parametrize("block", [40, 8_000_000])
def test_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rows = [(k, t, 7, "z") for k, t in enumerate(ODD)] + [(50, None, None, "z"), (None, "no id", 7, "z"), (3, "again", 7, None), (3, "again", 7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a int, block string").repartition(3)
    got = alignment.aligned(docs, TOKENIZER, PIECES, keep=("doc_id", "n_a", "block")).collect()
    want = sorted((str(r[0]), str(r[3]), *w) for r, w in zip(rows, plain([r[1] for r in rows])))
    assert sorted((str(r.doc_id), str(r.block), *(r[c] for c in COLUMNS), r.groups) for r in got) == want
    assert alignment.aligned(docs.where("false"), TOKENIZER, PIECES).count() == 0
