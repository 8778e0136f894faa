"""Language of a text by compression: the dictionary that makes it smallest tells its language.

For each language the normalised texts of a bounded sample form a raw-content zstandard dictionary. A text is encoded
with every dictionary and gets the language with the smallest sum of sizes; how far the next one is behind gives the
score, and a narrow margin marks the answer as rejected. Long texts are encoded in blocks, all of them; for short ones,
where sizes in whole bytes tie, the sizes under several smaller dictionaries are added up.

Defined results: ``und`` for null texts and texts without a letter, and where nothing could be learned. Only the text
goes into a prediction. Rows that repeat are judged each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.common import least_hashes, ship

DOCUMENTS = 400  # so many distinct sample texts of a language, if it has them
DICTIONARY = 160_000  # bytes of a language's dictionary
PIECE = DICTIONARY // 8  # bytes of a sample text, from its beginning
SHARDS = 5
SHORT = 600  # bytes up to which the smaller dictionaries are asked too
BLOCK = 16_384
LEVEL = 3
MARGIN = 0.75  # score below which an answer is rejected
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def normalised(text: str) -> bytes:
    return (" " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode()


def learn(documents: DataFrame, usable: Column, text: str = "text", lang: str = "lang", sample: int = DOCUMENTS) -> Model:
    """Dictionaries from ``sample`` distinct texts of each language among the ``usable`` rows, those with the smallest hashes.

    Copies of a text count once, so a language with any text is learned. What reaches the driver is bounded by the number
    of languages: hashes, and the first ``PIECE`` bytes of the sample texts.
    """
    ship(documents.sparkSession)
    rows = documents.where(usable & F.col(lang).isNotNull() & F.regexp_like(F.coalesce(F.col(text), F.lit("")), F.lit(r"\p{L}")))
    rows = rows.select(F.col(lang).alias("l"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    upto = least_hashes(rows, sample)
    if not upto:
        return Model((), ())

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            own = []
            for row in batch.to_pylist():
                if (row["l"], row["h"]) not in seen:
                    seen.add((row["l"], row["h"]))
                    own.append({"l": row["l"], "h": row["h"], "piece": normalised(row["t"])[:PIECE]})
            yield pa.RecordBatch.from_pylist(own, schema=pa.schema([("l", pa.string()), ("h", pa.int64()), ("piece", pa.binary())]))

    of_language = F.create_map(*(F.lit(v) for pair in upto.items() for v in pair))
    some = rows.where(F.col("h") <= of_language[F.col("l")]).mapInArrow(pieces, "l string, h long, piece binary")
    texts: dict[str, list[tuple[int, bytes]]] = {}
    for r in some.groupBy("l", "h").agg(F.min("piece").alias("piece")).collect():
        texts.setdefault(r.l, []).append((r.h, bytes(r.piece)))
    names = tuple(sorted(texts))
    content = []
    for name in names:
        parts, size = [], 0
        for _, part in sorted(texts[name]):
            if size >= DICTIONARY:
                break
            parts.append(part)
            size += len(part)
        content.append(b"".join(parts)[:DICTIONARY])
    return Model(names, tuple(content))


class Judge:
    """Compressors of a model, made once per worker."""

    def __init__(self, model: Model):
        self.model = model
        self.whole = [self._compressor(d) for d in model.dictionaries]
        self.shards = [[self._compressor(d[k * len(d) // SHARDS : (k + 1) * len(d) // SHARDS]) for k in range(SHARDS)] for d in model.dictionaries]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(content) < 8:
            return zstandard.ZstdCompressor(**options)
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=known, **options)

    def sizes(self, data: bytes) -> np.ndarray:
        """Bytes of ``data`` under each language, all blocks together."""
        blocks = [data[k : k + BLOCK] for k in range(0, len(data), BLOCK)]
        out = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.whole], np.float64)
        if len(data) <= SHORT:
            out += [sum(len(c.compress(data)) for c in group) for group in self.shards]
            out /= 2
        return out

    def judge(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.languages:
            return UNKNOWN, 0.0
        data = normalised(text)
        if not any(map(str.isalpha, data.decode())):
            return UNKNOWN, 0.0
        sizes = self.sizes(data)
        best = int(np.argmin(sizes))
        return self.model.languages[best], float(1.0 / np.exp2(np.maximum(-(sizes - sizes[best]), -500.0)).sum())


_JUDGES: dict[Model, Judge] = {}


def with_language(documents: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred``, ``score`` (0 to 1) and ``rejected`` (a narrow margin) of every whole text."""
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)  # bounded: DICTIONARY bytes a language
    kept = list(keep)
    schema = T.StructType([documents.schema[c] for c in kept]).add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("rejected", T.BooleanType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _JUDGES.get(sent.value)
        if own is None:
            _JUDGES.clear()
            own = _JUDGES[sent.value] = Judge(sent.value)
        for batch in batches:
            found = [own.judge(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[1] < MARGIN for f in found])],
                names=schema.names,
            )

    return documents.select(*kept, F.col(text).alias("_text")).mapInArrow(run, schema)
