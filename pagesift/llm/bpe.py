"""Byte-level BPE over whole arrays of words: frequent words by transducer, all others by exact merges.

``Encoder`` gives the ids that the ``tokenizers`` library gives for a byte-level BPE file without dropout and without
special tokens around the text. A chunk of texts is split into words on arrays of characters; equal words of a chunk are
looked up once. A word that the lexicon lacks is merged pair by pair, the pair of lowest rank first, for all such words
side by side; words of more than ``LONG`` bytes go through a heap, one by one.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat
from pathlib import Path

import numpy as np

from pagesift.llm.lexicon import compile_lexicon, look_up, map_arrays, write_arrays

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
LONG = 200  # bytes of a word beyond which merges go through a heap
CHUNK = 500_000  # characters that are handled at once: some 50 bytes of arrays stand behind each
REMEMBERED = 300_000  # merged words that a worker keeps before it starts anew, some 200 bytes each
BESIDE_LEXICON = 120_000  # the same where a lexicon holds the frequent words
_NEVER = np.int32(np.iinfo(np.int32).max)
_HASH = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 19


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point as the split pattern sees it."""
    import regex

    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for found in regex.finditer(pattern, points):
            out[ord(found[0][0]) : ord(found[0][-1]) + 1] = kind
    return out


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, as letter -> byte.

    Printable Latin-1 bytes stand for themselves; the others follow from code point 256 on, in order.
    """
    plain = [b for b in range(256) if chr(b) != " " and unicodedata.category(chr(b))[0] not in "CZ"]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _slots(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * _HASH) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


def tokenizer_arrays(path: str) -> dict[str, np.ndarray]:
    """Bytes of every id and a hash table of merges (pair of ids -> rank and new id) from a tokenizer file."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model, letters = spec["model"], byte_letters()
    vocab = model["vocab"]
    extra = {x["content"]: x["id"] for x in spec["added_tokens"]}
    n = 1 + max([*vocab.values(), *extra.values()])
    pieces = [b""] * n
    for text, k in vocab.items():
        pieces[k] = bytes(letters[c] for c in text)
    for text, k in extra.items():
        pieces[k] = text.encode()
    byte_ids = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    keys, size = left * n + right, 1 << _SLOT_BITS
    table, value = np.full(size, -1, np.int64), np.zeros(size, np.int64)
    for key, slot, rank in zip(keys.tolist(), _slots(keys).tolist(), range(len(pairs))):
        while table[slot] >= 0 and table[slot] != key:
            slot = (slot + 1) % size
        table[slot], value[slot] = key, rank
    ends = np.cumsum([len(p) for p in pieces])
    return {
        "piece_bytes": np.frombuffer(b"".join(pieces), np.uint8),
        "piece_ends": ends.astype(np.int64),
        "byte_ids": byte_ids.astype(np.int32),
        "merge_keys": table,
        "merge_ranks": value.astype(np.int32),
        "merge_made": made.astype(np.int32),
        "special_ids": np.array(sorted(extra.values()), np.int64),
    }


class Encoder:
    """Texts to ids and back; built once per worker from the arrays of ``compile_encoder``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays
        self.n = len(arrays["piece_ends"])
        ends, data = arrays["piece_ends"].tolist(), arrays["piece_bytes"].tobytes()
        self.pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
        self.special = {self.pieces[k].decode(): k for k in arrays["special_ids"].tolist()}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        both = np.repeat(arrays["byte_ids"], 256), np.tile(arrays["byte_ids"], 256)
        self.byte_pairs = self._ranks(*both)
        self._forget()
        self.special_any = re.compile("|".join(map(re.escape, self.special))) if self.special else None

    # -- splitting ---------------------------------------------------------------------------------------------

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of the texts, and of each word its start, its length and the text it belongs to."""
        joined = "\x00".join(texts) + "\x00"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8"), np.uint8)
        kinds = character_classes()[points]
        breaks = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1
        kinds[breaks] = BREAK
        first = np.empty(len(points), bool)
        first[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
        first[breaks] = True
        after = breaks[:-1] + 1
        first[after] = True
        # the last white space of a run goes with what follows it, as a part of it if it is a blank
        heads = np.flatnonzero(first[1:] & (kinds[1:] != BREAK) & (kinds[1:] != SPACE) & (kinds[:-1] == SPACE)) + 1
        first[heads - 1] = True
        first[heads] = points[heads - 1] != 32
        # 's 't 'm 'd 're 've 'll are words where nothing before them takes the apostrophe
        marks = np.flatnonzero((points == 39) & first)
        marks = marks[kinds[np.minimum(marks + 1, len(points) - 1)] == LETTER]
        if len(marks):
            one = points[marks + 1]
            two = points[np.minimum(marks + 2, len(points) - 1)]
            size = np.where(np.isin(one, [115, 116, 109, 100]), 1, 0)
            pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            size = np.where(pair, 2, size)
            marks, size = marks[size > 0], size[size > 0]
            first[marks + 1] = False
            first[marks + 1 + size] = True
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(points))
        width = np.ones(len(points), np.int64)
        if len(data) != len(points):
            width += (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
            places = np.concatenate([[0], np.cumsum(width)])
            starts, lengths = places[begins], places[ends] - places[begins]
        else:
            starts, lengths = begins, ends - begins
        word = kinds[begins] != BREAK
        owner = np.cumsum(~word)  # breaks before a word = number of its text
        return data, starts[word], lengths[word], owner[word]

    @staticmethod
    def distinct(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of one word of each kind, and the kind of every word.

        Words meet in the slots of a hash table. The first 16 bytes, as two numbers, and the length are compared
        exactly there; longer words are compared byte by byte at the end.
        """
        n = len(starts)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        eights = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))
        keep = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
        head = eights[starts] & keep[np.minimum(lengths, 8)]
        more = np.flatnonzero(lengths > 8)
        tail = np.zeros(n, np.uint64)
        tail[more] = eights[starts[more] + 8] & keep[np.minimum(lengths[more] - 8, 8)]
        with np.errstate(over="ignore"):
            hashes = (head * _HASH) ^ ((tail + lengths.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F))
            long = np.flatnonzero(lengths > 16)
            if len(long):
                size = lengths[long] - 16
                powers = _powers(int(size.max()))
                offsets = _ranges(size)
                terms = (padded[np.repeat(starts[long] + 16, size) + offsets].astype(np.uint64) + np.uint64(1)) * powers[offsets]
                tail[long] ^= np.add.reduceat(terms, np.cumsum(size) - size) * _HASH
                hashes[long] ^= tail[long] * np.uint64(0x165667B19E3779F9)
            hashes ^= hashes >> np.uint64(31)
        bits = max(int(2 * n).bit_length(), 4)
        table = np.empty(1 << bits, np.int32)
        first = np.arange(n, dtype=np.int32)
        todo = first.copy()
        while len(todo):
            with np.errstate(over="ignore"):
                hashes[todo] *= _HASH
            slot = (hashes[todo] >> np.uint64(64 - bits)).astype(np.int64)
            table[slot] = todo
            met = table[slot]
            same = (head[met] == head[todo]) & (tail[met] == tail[todo]) & (lengths[met] == lengths[todo])
            first[todo[same]] = met[same]
            todo = todo[~same]
        twins = long[first[long] != long] if len(long) else long
        if len(twins):
            size = lengths[twins]
            offsets = _ranges(size)
            mine = data[np.repeat(starts[twins], size) + offsets]
            theirs = data[np.repeat(starts[first[twins]], size) + offsets]
            differ = np.repeat(twins, size)[mine != theirs]
            first[differ] = differ  # two words with one hash: each is a kind of its own
        own = first == np.arange(n)
        number = np.cumsum(own) - 1
        return np.flatnonzero(own), number[first]

    # -- merging -----------------------------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``_NEVER`` where there is none."""
        table, size = self.a["merge_keys"], 1 << _SLOT_BITS
        keys = left.astype(np.int64) * self.n + right
        slot = _slots(keys)
        held = table[slot]
        out = np.full(len(keys), _NEVER, np.int32)
        hit = held == keys
        out[hit] = self.a["merge_ranks"][slot[hit]]
        todo = np.flatnonzero(~hit & (held >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % size
            held = table[slot[todo]]
            hit = held == keys[todo]
            out[todo[hit]] = self.a["merge_ranks"][slot[todo[hit]]]
            todo = todo[~hit & (held >= 0)]
        return out

    def merge(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words, one after the other, and the number of ids of each."""
        counts = np.zeros(len(starts), np.int64)
        done_word, done_place, done_ids = [], [], []
        long = np.flatnonzero(lengths > LONG)
        for w in long.tolist():
            ids = self.merge_long(data[starts[w] : starts[w] + lengths[w]])
            counts[w] = len(ids)
            done_word.append(np.full(len(ids), w))
            done_place.append(np.arange(len(ids)))
            done_ids.append(np.array(ids, np.int32))
        words = np.flatnonzero(lengths <= LONG)
        size = lengths[words]
        raw = data[np.repeat(starts[words], size) + _ranges(size)]
        ids = self.a["byte_ids"][raw]
        word = np.repeat(words.astype(np.int32), size)
        last = np.zeros(len(ids), bool)
        last[np.cumsum(size) - 1] = True
        rank = self.byte_pairs[np.append(raw[:-1].astype(np.int64) * 256 + raw[1:], 0)[: len(raw)]]
        rank[last] = _NEVER
        while len(ids):
            heads = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            size = np.diff(np.append(heads, len(ids)))
            lowest = np.minimum.reduceat(rank, heads)
            ended = lowest == _NEVER
            if ended.any():
                out = np.repeat(ended, size)
                counts[word[heads[ended]]] = size[ended]
                done_word.append(word[out])
                done_place.append(_ranges(size[ended]))
                done_ids.append(ids[out])
                go = ~out
                ids, word, last, rank = ids[go], word[go], last[go], rank[go]
                size, lowest = size[~ended], lowest[~ended]
                if not len(ids):
                    break
            low = np.repeat(lowest, size)
            join = rank == low
            if (join[1:] & join[:-1]).any():  # of pairs that overlap, the first, third, ... are joined
                run = np.maximum.accumulate(np.where(join, 0, np.arange(1, len(ids) + 1)))
                join &= (np.arange(len(ids)) - run) % 2 == 0
            at = np.flatnonzero(join)
            ids[at] = self.a["merge_made"][rank[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            stale = np.zeros(len(ids), bool)
            stale[at] = True
            stale[np.maximum(at - 1, 0)] = True
            left_of = at[at >= 2] - 2  # the neighbour on the left may itself have been taken in
            stale[left_of] = True
            ids, word, last, rank, stale = ids[keep], word[keep], last[keep], rank[keep], stale[keep]
            rank[last] = _NEVER
            look = np.flatnonzero(stale & ~last)
            rank[look] = self._ranks(ids[look], ids[look + 1])
        if not done_ids:
            return np.zeros(0, np.int32), counts
        word, place, ids = map(np.concatenate, (done_word, done_place, done_ids))
        begin = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(len(ids), np.int32)
        flat[begin[word] + place] = ids
        return flat, counts

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_ids, self.known_ends = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)

    def merged(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word's ids in ``known_ids`` and their number; words not met before are merged now."""
        if len(self.known) + len(starts) > (min(REMEMBERED, BESIDE_LEXICON) if "base" in self.a else REMEMBERED):
            self._forget()
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist())]
        number = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(number < 0)
        if len(new):
            ids, counts = self.merge(data, starts[new], lengths[new])
            n = len(self.known)
            used = int(self.known_ends[n])
            while used + len(ids) > len(self.known_ids):
                self.known_ids = np.concatenate([self.known_ids, np.zeros_like(self.known_ids)])
            while n + len(new) + 1 > len(self.known_ends):
                self.known_ends = np.concatenate([self.known_ends, np.zeros_like(self.known_ends)])
            self.known_ids[used : used + len(ids)] = ids
            self.known_ends[n + 1 : n + 1 + len(new)] = used + np.cumsum(counts)
            number[new] = np.arange(n, n + len(new))
            self.known.update(zip([words[k] for k in new.tolist()], range(n, n + len(new))))
        begin = self.known_ends[number]
        return begin, self.known_ends[number + 1] - begin

    def merge_long(self, data: np.ndarray) -> list[int]:
        """One long word: a heap of pairs over a doubly linked list."""
        ids = self.a["byte_ids"][data].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        version = [0] * n
        made = self.a["merge_made"]

        def entry(i: int, rank: int):
            return (rank, i, version[i], version[after[i]])

        first = self._ranks(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()
        heap = [entry(i, r) for i, r in enumerate(first) if r != _NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i, mine, theirs = heapq.heappop(heap)
            j = after[i]
            if mine != version[i] or j < 0 or theirs != version[j] or ids[i] < 0:
                continue
            ids[i], ids[j] = int(made[rank]), -1
            version[i] += 1
            version[j] += 1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    r = int(self._ranks(np.array([ids[k]], np.int64), np.array([ids[after[k]]], np.int64))[0])
                    if r != _NEVER:
                        heapq.heappush(heap, entry(k, r))
        return [x for x in ids if x >= 0]

    # -- texts -------------------------------------------------------------------------------------------------

    def _chunk(self, texts: list[str]) -> list[np.ndarray]:
        data, starts, lengths, owner = self.split(texts)
        if not len(starts):
            return [np.zeros(0, np.uint32) for _ in texts]
        sample, kind = self.distinct(data, starts, lengths)
        place = look_up(self.a, data, starts[sample], lengths[sample]) if "base" in self.a else np.full(len(sample), -1)
        unseen, seen = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
        begin = np.empty(len(sample), np.int64)
        count = np.empty(len(sample), np.int64)
        begin[unseen], count[unseen] = self.merged(data, starts[sample[unseen]], lengths[sample[unseen]])
        pool = self.known_ids
        if len(seen):
            ends, p = self.a["word_ends"], place[seen]
            first = np.where(p > 0, ends[p - 1], 0)
            begin[seen], count[seen] = first + len(pool), ends[p] - first
            pool = np.concatenate([pool, self.a["word_ids"]])
        size = count[kind]
        flat = pool[np.repeat(begin[kind], size) + _ranges(size)].astype(np.uint32)
        per_text = np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)
        return np.split(flat, np.cumsum(per_text)[:-1])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of every text, in order. Texts are handled in chunks; a special token's own text becomes its id."""
        batch: list[str] = []
        shape: list[list[int]] = []  # per text: special ids as -1 - id, parts as their place in the batch
        held = 0
        for text in texts:
            parts = self.special_split.split(text) if self.special_any and self.special_any.search(text) else [text]
            plan = []
            for part in parts:
                if part in self.special:
                    plan.append(-1 - self.special[part])
                elif part or len(parts) == 1:
                    plan.append(len(batch))
                    batch.append(part)
            shape.append(plan)
            held += len(text) + 1
            if held >= CHUNK:
                yield from self._flush(batch, shape)
                batch, shape, held = [], [], 0
        if shape:
            yield from self._flush(batch, shape)

    def _flush(self, batch: list[str], shape: list[list[int]]) -> Iterator[np.ndarray]:
        parts = self._chunk(batch) if batch else []
        for plan in shape:
            if len(plan) == 1 and plan[0] >= 0:
                yield parts[plan[0]]
            else:
                yield np.concatenate([parts[k] if k >= 0 else np.array([-1 - k], np.uint32) for k in plan]).astype(np.uint32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))


_BASE = 0x2545F4914F6CDD1D


@lru_cache(maxsize=4)
def _powers_cached(bits: int, base: int) -> np.ndarray:
    out = np.empty(1 << bits, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        step, filled = np.uint64(base), 1
        while filled < len(out):
            out[filled : 2 * filled] = out[:filled] * step
            step, filled = step * step, 2 * filled
    return out


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """At least ``n`` powers, modulo 2**64, of an odd number or of its inverse."""
    return _powers_cached(max(int(n - 1).bit_length(), 1), pow(_BASE, -1, 1 << 64) if inverse else _BASE)


def _ranges(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ..., size - 1 for every size, one after the other."""
    total = int(sizes.sum())
    return np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def compile_encoder(tokenizer: str, words: list[str]) -> dict[str, np.ndarray]:
    """All arrays an ``Encoder`` needs: the tokenizer file and a lexicon of the given frequent words."""
    arrays = tokenizer_arrays(tokenizer)
    raw = sorted({w.encode() for w in words if w})
    if raw:
        plain = Encoder(arrays)
        data = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.array([len(w) for w in raw], np.int64)
        ids, counts = plain.merge(data, np.cumsum(lengths) - lengths, lengths)
        arrays |= compile_lexicon(raw) | {"word_ids": ids, "word_ends": np.cumsum(counts)}
    return arrays


def save_encoder(arrays: dict[str, np.ndarray], path: str) -> None:
    write_arrays(path, arrays)


@lru_cache(maxsize=2)
def open_encoder(path: str) -> Encoder:
    return Encoder(map_arrays(path))
