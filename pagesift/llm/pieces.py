"""Pair-merging segmentation of marked words into the pieces of a SentencePiece BPE model.

``Pieces`` gives the ids that the ``sentencepiece`` library gives for a BPE model with byte fallback, identity
normalisation and a dummy prefix. No piece of such a model goes on past a space marker that follows another character,
so a text falls into marked words (a run of spaces and what stands behind it) that never influence each other. Words are
merged side by side on arrays, one pair of each word a round: the best score first, the leftmost of equal ones; words of
more than ``LONG`` characters go through a heap. Any U+2581 of a text is a space to the model, and is read as one here.
"""

from __future__ import annotations

import codecs
import heapq
from itertools import repeat

import numpy as np
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from pagesift.llm.bpe import Encoder, _ranges

MARKER = "▁"
LONG = 64  # characters of a word beyond which merges go through a heap
REMEMBERED = 300_000  # words whose ids a worker keeps before it starts anew
_NEVER = np.int64(1) << 40


_SLOT_BITS = 18  # of the table of pairs; a vocabulary of 32,000 pieces has some 60,000


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


codecs.register_error("each-byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


def piece_arrays(path: str) -> dict[str, np.ndarray]:
    """Bytes and kind of every piece, and the table of pairs that make a piece, from a model file.

    Raises ValueError for models that this module does not follow (another algorithm, normalisation, no byte fallback,
    pieces with a space marker behind another character).
    """
    model = model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = model_pb2.ModelProto.SentencePiece
    spec, norm = model.trainer_spec, model.normalizer_spec
    known = {kinds.NORMAL, kinds.BYTE, kinds.CONTROL, kinds.UNKNOWN}
    if (
        spec.model_type != spec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix or norm.precompiled_charsmap
        or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or any(p.type not in known for p in model.pieces)
    ):
        raise ValueError(f"{path}: not a plain BPE model with byte fallback and identity normalisation")
    normal = {p.piece: k for k, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
    if any(MARKER in p.lstrip(MARKER) for p in normal):
        raise ValueError(f"{path}: a piece holds a space marker behind another character")
    byte_ids = np.full(256, -1, np.int64)
    texts = []
    for k, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids[int(p.piece[3:5], 16)] = k
            texts.append(bytes([int(p.piece[3:5], 16)]))
        else:
            texts.append(p.piece.replace(MARKER, " ").encode() if p.type == kinds.NORMAL else b"")
    # single characters that are no pieces still take part in pairs: they get numbers behind the ids
    number = dict(normal)
    for c in sorted({c for p in normal for c in p}):
        number.setdefault(c, len(texts) + len(number) - len(normal))
    size = len(texts) + len(number) - len(normal) + 1  # the last number: characters of no piece
    score = {p: model.pieces[k].score for p, k in normal.items()}
    rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
    pairs = sorted(
        (number[p[:cut]] * size + number[p[cut:]], k, rank[score[p]])
        for p, k in normal.items()
        for cut in range(1, len(p))
        if p[:cut] in number and p[cut:] in number
    )
    slots = np.full(1 << _SLOT_BITS, -1, np.int32)
    for place, slot in enumerate(_slots(np.array([k for k, _, _ in pairs], np.int64)).tolist()):
        while slots[slot] >= 0:
            slot = (slot + 1) % len(slots)
        slots[slot] = place
    single = sorted((ord(" " if c == MARKER else c), k) for c, k in number.items() if len(c) == 1)
    ends = np.cumsum([len(t) for t in texts])
    return {
        "piece_bytes": np.frombuffer(b"".join(texts), np.uint8),
        "piece_ends": ends.astype(np.int64),
        "byte_ids": byte_ids,
        "is_byte": np.array([p.type == kinds.BYTE for p in model.pieces]),
        "points": np.array([c for c, _ in single], np.int64),
        "point_ids": np.array([k for _, k in single], np.int64),
        "pair_keys": np.array([k for k, _, _ in pairs], np.int64),
        "pair_made": np.array([k for _, k, _ in pairs], np.int64),
        "pair_ranks": np.array([k for _, _, k in pairs], np.int64),
        "slots": slots,
        "size": np.array([size], np.int64),
        "end_id": np.array([sentencepiece.SentencePieceProcessor(model_file=path).eos_id()], np.int64),
    }


def marked_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the texts with their dummy prefix, and of each marked word its start, length and text."""
    raw = [(" " + t.replace(MARKER, " ")).encode() if t else b"" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    if not len(data):
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    blank = data == 32
    first = blank.copy()
    first[1:] &= ~blank[:-1]
    heads = (np.cumsum(sizes) - sizes)[sizes > 0]
    first[heads] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(data)))
    owner = np.searchsorted(np.cumsum(sizes), starts, "right")
    return data, starts, lengths, owner


class Pieces:
    """Marked words to ids and ids to text; built once per worker from ``piece_arrays``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays
        self.size = int(arrays["size"][0])
        self.end_id = int(arrays["end_id"][0])
        ends, data = arrays["piece_ends"].tolist(), arrays["piece_bytes"].tobytes()
        self.pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
        self.of_point = np.full(0x110000, self.size - 1, np.int32)
        self.of_point[arrays["points"]] = arrays["point_ids"]
        self._forget()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, ``_NEVER`` where it makes no piece, and its place in the table."""
        keys = left.astype(np.int64) * self.size + right
        table = self.a["slots"]
        slot = _slots(keys)
        at = table[slot]
        todo = np.flatnonzero((at >= 0) & (self.a["pair_keys"][at] != keys))
        while len(todo):  # the slot holds another pair: its own may stand in the next ones
            slot[todo] = (slot[todo] + 1) % len(table)
            at[todo] = table[slot[todo]]
            todo = todo[(at[todo] >= 0) & (self.a["pair_keys"][at[todo]] != keys[todo])]
        return np.where(at >= 0, self.a["pair_ranks"][at], _NEVER), at

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given marked words, one word after the other, and the number of ids of each."""
        points = np.frombuffer(b"".join(words).decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        bounds = heads[np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])]
        size = np.diff(bounds)
        ids = self.of_point[points].astype(np.int64)
        alive = np.ones(len(ids), bool)
        for w in np.flatnonzero(size > LONG).tolist():
            self._merge_long(ids, alive, int(bounds[w]), int(bounds[w + 1]))
        short = np.flatnonzero((size > 1) & (size <= LONG))
        if len(short):
            at = np.repeat(bounds[short], size[short]) + _ranges(size[short])
            self._merge_short(ids, alive, at, size[short])
        # what no pair took in: pieces as they are, characters of no piece as their bytes
        word = np.repeat(np.arange(len(words)), size)[alive]
        left, point = ids[alive], points[alive]
        n_pieces = len(self.pieces)
        odd = left >= n_pieces
        if not odd.any():
            return left.astype(np.int32), np.bincount(word, minlength=len(words))
        spread = np.where(odd, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000), 1)
        begin = np.cumsum(spread) - spread
        out = np.repeat(left, spread)
        as_bytes = np.frombuffer(point[odd].astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        places = np.repeat(begin[odd], spread[odd]) + _ranges(spread[odd])
        out[places] = self.a["byte_ids"][as_bytes]
        return out.astype(np.int32), np.bincount(word, weights=spread, minlength=len(words)).astype(np.int64)

    def _merge_short(self, ids: np.ndarray, alive: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Merge the words that lie at the places ``at``; ``size`` characters each. Changes ``ids`` and ``alive``."""
        own, size = ids[at], size.copy()
        last = np.zeros(len(own), bool)
        last[np.cumsum(size) - 1] = True
        rank, made = self._ranks(own, np.append(own[1:], 0))
        rank[last] = _NEVER
        while len(own):
            heads = np.cumsum(size) - size
            key = (rank << 20) + _ranges(size)
            best = np.minimum.reduceat(key, heads)
            go = best < (_NEVER << 20)
            if not go.all():
                ended = ~np.repeat(go, size)
                ids[at[ended]] = own[ended]
                stay = ~ended
                own, at, last, rank, made = own[stay], at[stay], last[stay], rank[stay], made[stay]
                size, best = size[go], best[go]
                heads = np.cumsum(size) - size
                if not len(own):
                    return
            p = heads + (best & ((1 << 20) - 1))
            own[p] = self.a["pair_made"][made[p]]
            last[p] = last[p + 1]
            alive[at[p + 1]] = False
            keep = np.ones(len(own), bool)
            keep[p + 1] = False
            p = p - np.arange(len(p))  # one place fewer for every word before
            own, at, last, rank, made, size = own[keep], at[keep], last[keep], rank[keep], made[keep], size - 1
            before = p[p > 0] - 1
            look = np.concatenate([p, before[~last[before]]])
            rank[p] = _NEVER
            look = look[~last[look]]
            rank[look], made[look] = self._ranks(own[look], own[look + 1])

    def _merge_long(self, ids: np.ndarray, alive: np.ndarray, start: int, end: int) -> None:
        """One long word: a heap of pairs over a doubly linked list. Changes ``ids`` and ``alive`` between the ends."""
        own = ids[start:end].tolist()
        n = len(own)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        ranks, places = self._ranks(ids[start : end - 1], ids[start + 1 : end])
        heap = [(r, i, own[i], own[i + 1], m) for i, (r, m) in enumerate(zip(ranks.tolist(), places.tolist())) if r != _NEVER]
        heapq.heapify(heap)
        pair: dict[tuple[int, int], tuple[int, int]] = {}
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if own[i] != a or j < 0 or own[j] != b:
                continue
            own[i], own[j] = int(self.a["pair_made"][m]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    both = own[k], own[after[k]]
                    if both not in pair:
                        r, place = self._ranks(np.array(both[:1]), np.array(both[1:]))
                        pair[both] = int(r[0]), int(place[0])
                    if pair[both][0] != _NEVER:
                        heapq.heappush(heap, (pair[both][0], k, *both, pair[both][1]))
        ids[start:end] = own
        alive[start:end] = ids[start:end] >= 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text without special ids; each distinct word of the texts is segmented or looked up once."""
        data, starts, lengths, owner = marked_words(texts)
        if not len(starts):
            return [np.zeros(0, np.int32) for _ in texts]
        sample, kind = Encoder.distinct(data, starts, lengths)
        raw = data.tobytes()
        words = [raw[a : a + n] for a, n in zip(starts[sample].tolist(), lengths[sample].tolist())]
        if len(self.known) + len(words) > REMEMBERED:
            self._forget()
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            ids, counts = self.segment(fresh)
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(fresh, number[new].tolist()))
            self.ends = np.concatenate([self.ends, len(self.pool) + np.cumsum(counts)])
            self.pool = np.concatenate([self.pool, ids])
        return join_ids(self.pool, self.ends, number[kind], np.bincount(owner, minlength=len(texts)))

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.pool, self.ends = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids as the library gives it: control ids are silent, one leading space of the first piece goes,
        and bytes that make no character become U+FFFD, one each."""
        ids = np.asarray(ids, np.int64)
        ends = self.a["piece_ends"]
        silent = np.flatnonzero(ends[ids] == np.where(ids > 0, ends[ids - 1], 0))
        out, first = [], True
        for part in np.split(ids, silent):  # a silent id parts the bytes around it
            raw = b"".join(map(self.pieces.__getitem__, part.tolist()))
            if not raw:
                continue
            if first and raw[:1] == b" " and not self.a["is_byte"][part[np.flatnonzero(~np.isin(part, ids[silent]))[0]]]:
                raw = raw[1:]
            out.append(raw.decode("utf-8", "each-byte"))
            first = False
        return "".join(out)


def join_ids(pool: np.ndarray, ends: np.ndarray, code: np.ndarray, per_text: np.ndarray) -> list[np.ndarray]:
    """Ids of texts from the ids of their words: ``code`` numbers the words, ``ends`` bounds each one's ids in ``pool``."""
    size = np.diff(np.concatenate([[0], ends]))
    taken = size[code]
    flat = pool[np.repeat((ends - size)[code], taken) + _ranges(taken)]
    bounds = np.concatenate([[0], np.cumsum(taken)])[np.cumsum(per_text)[:-1]]
    return np.split(flat, bounds)
