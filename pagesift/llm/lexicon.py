"""A lexicon of words as a minimal acyclic transducer, laid out in flat arrays that are memory-mapped.

Words that share an end share its states, so a plain automaton could not say which word was read. Every arc
therefore carries the number of words that sort before the ones behind it; the sum along a path is the place of the
word in the sorted list, and that place leads to the word's ids. Arcs lie in one table (an arc of a state stands at the
state's base plus its byte), so a whole array of words is looked up with three gathers per byte position.
"""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np


def minimal_states(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """Arcs and final flags of the smallest automaton for ``words`` (sorted, distinct, not empty).

    States are merged as soon as no later word can change them: those are the states below the prefix that a word
    shares with the one before it. State 0 is the start.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []  # (state, byte, next state) of the last word

    def settle(keep: int) -> None:
        while len(path) > keep:
            state, byte, child = path.pop()
            key = (final[child], tuple(arcs[child].items()))
            arcs[state][byte] = known.setdefault(key, child)

    last = b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        settle(shared)
        state = path[-1][2] if path else 0
        for byte in word[shared:]:
            arcs.append({})
            final.append(False)
            path.append((state, byte, len(arcs) - 1))
            arcs[state][byte] = len(arcs) - 1
            state = len(arcs) - 1
        final[state] = True
        last = word
    settle(0)
    return arcs, final


def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arc table of the automaton: ``base`` and ``final`` per state, ``check``, ``target`` and ``before`` per place."""
    arcs, final = minimal_states(words)
    order, seen = [], {0}
    stack = [0]
    while stack:
        state = stack.pop()
        order.append(state)
        for child in arcs[state].values():
            if child not in seen:
                seen.add(child)
                stack.append(child)
    number = {state: k for k, state in enumerate(order)}
    counts: dict[int, int] = {}
    for top in order:  # words behind a state, children first
        work = [top]
        while work:
            state = work[-1]
            open_children = [c for c in arcs[state].values() if c not in counts]
            if open_children and state not in counts:
                work.extend(open_children)
                continue
            work.pop()
            counts.setdefault(state, final[state] + sum(counts[c] for c in arcs[state].values()))
    size = sum(len(arcs[s]) for s in order) * 2 + 1024
    check = np.full(size, -1, np.int32)
    taken = bytearray(size)
    base = np.zeros(len(order), np.int32)
    target = np.zeros(size, np.int32)
    before = np.zeros(size, np.int32)
    free = 256
    for state in sorted(order, key=lambda s: -len(arcs[s])):
        keys = sorted(arcs[state])
        if not keys:
            continue
        while taken[free]:
            free += 1
        place, tries = free, 0
        while True:
            tries += 1
            start = place - keys[0]
            if start + keys[-1] + 1 >= len(taken):
                more = len(taken)
                taken.extend(bytes(more))
                check = np.concatenate([check, np.full(more, -1, np.int32)])
                target = np.concatenate([target, np.zeros(more, np.int32)])
                before = np.concatenate([before, np.zeros(more, np.int32)])
            if start >= 0 and not any(taken[start + k] for k in keys):
                break
            place += 1
            while taken[place]:
                place += 1
        if tries > 20:  # this part of the table is as good as full
            free = place
        base[number[state]] = start
        passed = int(final[state])
        for key in keys:
            child = arcs[state][key]
            taken[start + key] = 1
            check[start + key] = number[state]
            target[start + key] = number[child]
            before[start + key] = passed
            passed += counts[child]
    slack = np.full(256, -1, np.int32)  # so that base + byte never leaves the table
    return {
        "base": base,
        "final": np.array([final[s] for s in order], np.uint8),
        "check": np.concatenate([check, slack]),
        "target": np.concatenate([target, slack * 0]),
        "before": np.concatenate([before, slack * 0]),
    }


def look_up(table: dict[str, np.ndarray], text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Place of each word ``text[start:start+length]`` in the sorted list, -1 for words that are not in it."""
    found = np.full(len(starts), -1, np.int64)
    active = np.flatnonzero(lengths > 0)
    state = np.zeros(len(active), np.int64)
    place = np.zeros(len(active), np.int64)
    at, left = starts[active], lengths[active]
    base, check, target, before, final = (table[k] for k in ("base", "check", "target", "before", "final"))
    while len(active):
        arc = base[state] + text[at]
        ok = check[arc] == state
        arc, active, place, at, left = arc[ok], active[ok], place[ok], at[ok] + 1, left[ok] - 1
        state = target[arc]
        place = place + before[arc]
        ended = left == 0
        if ended.any():
            accepted = ended & (final[state] == 1)
            found[active[accepted]] = place[accepted]
            go = ~ended
            state, active, place, at, left = state[go], active[go], place[go], at[go], left[go]
    return found


def write_arrays(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: length of the head, the head as JSON (name, type, shape, place), then the arrays."""
    head, at = {}, 0
    for name, array in arrays.items():
        head[name] = [array.dtype.str, list(array.shape), at]
        at += -(-array.nbytes // 64) * 64
    text = json.dumps(head).encode()
    start = -(-(8 + len(text)) // 64) * 64
    with Path(path).open("wb") as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for name, array in arrays.items():
            out.seek(start + head[name][2])
            out.write(np.ascontiguousarray(array).tobytes())
        out.truncate(start + at)


def map_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of ``write_arrays``, mapped into memory: the workers of a machine share the pages."""
    data = np.memmap(path, np.uint8, "r")
    size = int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8 : 8 + size].tobytes())
    start = -(-(8 + size) // 64) * 64
    out = {}
    for name, (kind, shape, at) in head.items():
        count = int(np.prod(shape)) * np.dtype(kind).itemsize
        out[name] = np.asarray(data[start + at : start + at + count]).view(kind).reshape(shape)
    return out
