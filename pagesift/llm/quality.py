"""Quality of documents without labels: heuristic labellers, their accuracies by expectation-maximisation, a linear scorer.

Each labeller votes good, bad or nothing. How often each combination of votes occurs is counted over all documents
(there are at most 3 ** LABELLERS of them), and expectation-maximisation estimates how often good and bad documents
get each vote of each labeller, and so how likely a combination is to be a good document. These posteriors are the labels
on which a linear scorer over hashed features is trained, on a bounded sample; the scorer then judges every whole text.

Defined results: null texts and texts without a word get score 0 and are not kept. Ties do not arise, a score of exactly
one half is kept. Repeated rows are judged each. With no text to learn from, all texts with a word are kept.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.bpe import LETTER, NUMBER, SPACE, character_classes
from pagesift.llm.common import least_hashes, ship, tidy, trimmed

SAMPLE = 4_000
BUCKETS = 4_096
KEEP = 0.5
LABELLERS = 8
_UPPER, _LOWER, _DIGIT, _BLANK, _FOREIGN = range(128, 133)


@dataclass(frozen=True)
class Model:
    weights: bytes  # float32, one for each bucket, and the bias
    accuracies: tuple[tuple[float, ...], ...] = ()  # per labeller: share of good documents voted good, of bad ones bad

    def array(self) -> np.ndarray:
        return np.frombuffer(self.weights, np.float32)


_SHAPES: list[np.ndarray] = []


def _shapes() -> np.ndarray:
    """Shape of every code point: upper case, other letter, digit, blank, the ASCII sign itself, any other sign."""
    if not _SHAPES:
        kinds = character_classes()
        out = np.full(0x110000, _FOREIGN, np.uint8)
        out[:128] = np.arange(128)
        out[kinds == LETTER] = _LOWER
        out[kinds == NUMBER] = _DIGIT
        out[kinds == SPACE] = _BLANK
        letters = np.flatnonzero(kinds == LETTER)
        out[[k for k in letters.tolist() if chr(k).isupper()]] = _UPPER
        _SHAPES.append(out)
    return _SHAPES[0]


def measures(text: str) -> tuple[np.ndarray, dict[str, float]]:
    """Shapes of the characters of a text, and the shares that the labellers look at."""
    shape = _shapes()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    words = text.split()
    n = max(len(words), 1)
    letters = int(((shape == _UPPER) | (shape == _LOWER)).sum())
    signs = int(((shape < 128) | (shape == _FOREIGN)).sum())
    counts = Counter(words)
    return shape, {
        "words": len(words),
        "signs": signs / max(len(text) - int((shape == _BLANK).sum()), 1),
        "upper": int((shape == _UPPER).sum()) / max(letters, 1),
        "again": sum(a == b for a, b in zip(words, words[1:])) / n,
        "bars": int((shape == ord("|")).sum()) / n,
        "stops": sum(w[-1] == "." for w in words) / n,
        "tails": sum(not (w[-1].isalnum() or w[-2:-1].isalnum() or len(w) == 1) for w in words) / n,
        "top": max(counts.values(), default=0) / n,
        "distinct": len(counts) / n,
    }


def votes(m: dict[str, float]) -> tuple[int, ...]:
    """Vote of each labeller: 1 good, 0 bad, 2 nothing. Seven look for one kind of junk each and are silent otherwise, as
    a text free of one kind may well be of another; the last one looks for sentences."""
    long = m["words"] >= 20

    def bad(holds: bool) -> int:
        return 0 if holds else 2

    return (
        bad(m["signs"] >= 0.14 and long),
        bad(m["tails"] >= 0.3),
        bad(m["upper"] >= 0.4 and m["words"] >= 5),
        bad(m["again"] >= 0.2 and long),
        bad(m["bars"] >= 0.1),
        bad(m["top"] >= 0.35 and long),
        bad(m["distinct"] <= 0.1 and long),
        1 if 0.01 <= m["stops"] <= (0.4 if long else 1.0) else 0 if long else 2,
    )


def code_of(v: tuple[int, ...]) -> int:
    return sum(x * 3**k for k, x in enumerate(v))


def votes_of(code: int) -> tuple[int, ...]:
    return tuple(code // 3**k % 3 for k in range(LABELLERS))


def estimate(counts: dict[int, int], rounds: int = 100) -> tuple[dict[int, float], np.ndarray]:
    """Posterior of being good for each combination, and P(vote | class) as an array (class, labeller, vote).

    The first posterior is the share of good votes. One is added to every expected count, so that no vote is impossible.
    """
    codes = sorted(counts)
    v = np.array([votes_of(c) for c in codes])
    w = np.array([counts[c] for c in codes], np.float64)
    good, cast = (v == 1).sum(1), (v != 2).sum(1)
    p = np.where(cast > 0, (good + 0.5) / (cast + 1.0), 0.5)
    chance = np.zeros((2, LABELLERS, 3))
    for _ in range(rounds):
        prior = (w @ p + 1) / (w.sum() + 2)
        for c, share in ((1, p), (0, 1 - p)):
            for vote in range(3):
                chance[c, :, vote] = ((v == vote) * (w * share)[:, None]).sum(0) + 1
            chance[c] /= chance[c].sum(1, keepdims=True)
        log = [np.log(x) + np.log(chance[c, np.arange(LABELLERS), v]).sum(1) for c, x in ((0, 1 - prior), (1, prior))]
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return dict(zip(codes, p.tolist())), chance


def features(shape: np.ndarray, m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: runs of four shapes (repeats taken as one) by the root of their share, and the measures by tenths."""
    turns = shape[np.concatenate([[True], shape[1:] != shape[:-1]])].astype(np.uint64) if len(shape) else np.zeros(0, np.uint64)
    padded = np.concatenate([np.full(3, 127, np.uint64), turns])
    with np.errstate(over="ignore"):
        h = ((padded[:-3] * np.uint64(133) + padded[1:-2]) * np.uint64(133) + padded[2:-1]) * np.uint64(133) + padded[3:]
        h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 12)
    place, count = np.unique(h.astype(np.int64), return_counts=True)
    value = np.sqrt(count / max(len(h), 1))
    extra = []
    for k, name in enumerate(("signs", "tails", "upper", "again", "bars", "top", "distinct")):
        extra.append((0x51ED27 * (16 * k + int(10 * min(m[name], 1.0))) + 977) % BUCKETS)
    return np.concatenate([place, extra]).astype(np.int64), np.concatenate([value, np.full(len(extra), 0.3)])


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Weights and bias of a logistic model for soft labels, by full gradients with per-weight steps."""
    x = np.zeros((len(rows), BUCKETS + 1), np.float32)
    for k, (place, value, _) in enumerate(rows):
        np.add.at(x[k], place, value)
    x[:, -1] = 1
    y = np.array([r[2] for r in rows], np.float32)
    w = np.zeros(BUCKETS + 1, np.float32)
    seen = np.full(BUCKETS + 1, 1e-6, np.float32)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        gradient = x.T @ (p - y) / len(y) + decay * w
        seen += gradient**2
        w -= 0.3 * gradient / np.sqrt(seen)
    return w


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tidy()
        codes = [code_of(votes(measures(t)[1])) for t in batch.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int32())], names=["code"])


def train(documents: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """Votes of all documents, posteriors, and a scorer fitted to ``sample`` distinct texts, those with the smallest hashes."""
    ship(documents.sparkSession)
    rows = documents.where(F.regexp_like(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S"))).select(F.col(text).alias("_text"))
    counts = {r.code: r["count"] for r in rows.mapInArrow(_measured, "code int").groupBy("code").count().collect()}
    if not counts:
        return Model(np.zeros(BUCKETS + 1, np.float32).tobytes())
    posterior, chance = estimate(counts)
    rows = rows.select(F.lit("").alias("l"), F.xxhash64("_text").alias("h"), "_text")
    upto = least_hashes(rows, sample)[""]

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            found = []
            for h, t in zip(batch.column("h").to_pylist(), batch.column("_text").to_pylist()):
                if h not in seen:
                    seen.add(h)
                    shape, m = measures(t)
                    found.append((h, *features(shape, m), code_of(votes(m))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int32()))],
                names=["h", "place", "value", "code"],
            )

    some = rows.where(F.col("h") <= upto).select("h", "_text").mapInArrow(trimmed(sampled), "h long, place array<long>, value array<double>, code int")
    one = some.groupBy("h").agg(F.min(F.struct("place", "value", "code")).alias("s")).orderBy("h").select("s.*")
    table = [(np.array(r.place), np.array(r.value), posterior[r.code]) for r in one.collect()]
    accuracies = tuple((float(chance[1, k, 1]), float(chance[0, k, 0])) for k in range(LABELLERS))
    return Model(fit(table).tobytes(), accuracies)


def with_quality(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``documents`` with ``quality_score`` (0 to 1) and ``kept``."""
    ship(documents.sparkSession)
    schema = T.StructType([*documents.schema.fields]).add("quality_score", T.DoubleType()).add("kept", T.BooleanType())
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.array().astype(np.float64)
        for batch in (part for whole in batches for part in (whole.slice(k, 1_000) for k in range(0, whole.num_rows, 1_000))):
            scores = []
            for t in batch.column(text).to_pylist():
                if not t or not t.strip():
                    scores.append(0.0)
                    continue
                place, value = features(*measures(t))
                scores.append(float(1 / (1 + np.exp(-np.clip(w[place] @ value + w[-1], -500, 500)))))
            tidy()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores, pa.float64()), pa.array([s >= KEEP for s in scores])], names=schema.names)

    return documents.mapInArrow(trimmed(run), schema)
