"""The prefix tree against plain loops, the forest against all its nodes."""

import hashlib
import random
import zlib
from itertools import pairwise

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle import connect, difference

from pagesift.llm import trie
from pagesift.llm.forest import Element, Item, Part, contract, edge_between, finish, side_by_side
from pagesift.llm.queries import ORACLES, op12_conversation_trie

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_nodes(sequences, size):
    """Rows of the contract for conversation -> tuple of turns, by loops over all prefixes."""
    members = {}
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members.setdefault(sequences[c][:d], []).append(c)
    children, out = {}, []
    for s in members:
        if s:
            children.setdefault(s[:-1], []).append(s)
    below = {}
    for s in sorted(members, key=len, reverse=True):
        kids = children.get(s, [])
        own = (len(members[s]) - 1) * size(s[-1]) if s else 0
        below[s] = sum(below[k][0] for k in kids) or 1, own + sum(below[k][1] for k in kids)
    for s, m in members.items():
        ends = ",".join(str(c) for c in m if len(sequences[c]) == len(s))
        parent = members[s[:-1]][0] if s else None
        out.append((m[0], len(s), parent, len(m), len(children.get(s, [])), *below[s], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def plain_rebuilt(rows):
    """conversation -> turns from (conv_id, turn, role, text)."""
    own = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = (*own.get(c - c % 100, [])[:h], *own[c][h:])
    return out


def text(r):
    return tuple(r[n] for n in NAMES)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=6), min_size=1, max_size=14), st.integers(1, 6), st.randoms(use_true_random=False))
def test_parts_of_any_size_give_all_nodes(lists, most, rng):
    sequences = {c: tuple(s) for c, s in enumerate(lists)}
    members, classes = {}, {}
    for c, s in sequences.items():
        classes.setdefault(s, []).append(c)
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    number = {s: (k, k) for k, s in enumerate(sorted(members, key=len))}
    rows = []
    for s, m in classes.items():
        cuts = [d for d in range(1, len(s) + 1) if len(members[s[:d]]) < len(members[s[: d - 1]])]
        key = [Element(d, number[s[:d]], sum(s[: d - 1]), number[s[: d - 1]]) for d in cuts]
        rows.append((key, Item(len(s), sum(s), number[s], len(m), min(m))))
    rows.sort(key=lambda r: r[0])
    parts, chains = [], []
    while rows:
        n = rng.randint(1, most)
        chunk, rows = rows[:n], rows[n:]
        part, final = contract(Part([r[1] for r in chunk], [edge_between(a[0], b[0]) for a, b in pairwise(chunk)], chunk[0][0], chunk[-1][0]))
        parts.append(part)
        chains += final
    while len(parts) > 1:
        part, final = contract(side_by_side(*parts[:2]))
        parts = [*parts[2:], part] if len(parts) == 2 else [part, *parts[2:]]
        chains += final
    chains += finish(parts[0])
    found = {}
    sequence_of = {v: s for s, v in number.items()}
    for c in chains:
        s = sequence_of[c.prefix]
        for d in range(c.low, c.high + 1):
            saved = c.below + (c.n - 1) * (c.points - sum(s[: max(d - 1, 0)]))
            found[s[:d]] = (c.least, d, c.n, c.children if d == c.high else 1, c.leaves, saved)
    want = {(r[0], r[1], *r[3:7]) for r in plain_nodes(sequences, int)}
    assert len(found) == len(members) and set(found.values()) == want


def check(spark, rows, extra=()):
    schema = "conv_id long, turn long, role string, text string" + "".join(f", {c} string" for c in extra)
    df = spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(5)
    got = trie.prefix_trie(df, trie.Lending()).collect()
    want = plain_nodes(plain_rebuilt(rows), lambda t: len(t[1]))
    assert sorted(map(str, map(text, got))) == sorted(map(str, want))


def test_query(spark, testdata):
    rows = spark.read.parquet(f"{testdata}/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = op12_conversation_trie(spark, f"{testdata}/sf0.01").collect()
    want = plain_nodes(plain_rebuilt([tuple(r) for r in rows]), lambda t: len(t[1]))
    assert sorted(map(str, map(text, got))) == sorted(map(str, want))


@pytest.mark.parametrize("small", [True, False])
def test_odd_rows(spark, monkeypatch, small):
    if small:
        for name, value in (("STRETCH", 3), ("CHUNK", 2), ("MERGED", 2), ("PIECE", 4), ("HOT", 5)):
            monkeypatch.setattr(trie, name, value)
    rng = random.Random(4)
    rows = [(rng.choice([0, 1, 2, 3, 100, 101, 205, 7]), None, "user", "first") for _ in range(1)]
    for c in [*range(30), 100, 101, 150, 205, 206, 999]:  # 200 and 900 do not exist
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "é中😀"])) for t in range(rng.choice([0, 1, 2, 3, 7]))]
    rows += [(300, t, "user", f"turn {t}") for t in range(400)] + [(c, t, "user", f"turn {t}") for c in range(301, 340) for t in range(9)]
    check(spark, rows, extra=("depth", "p1", "own", "length"))


def test_repeated_rows_and_rows_without_conversation(spark):
    rows = [(5, 1, "user", "x"), (5, 1, "user", "x"), (5, 9, "user", "y"), (6, None, None, None), (7, -3, "", "")]
    df = spark.createDataFrame([*rows, (None, 1, "user", "z")], "conv_id long, turn long, role string, text string")
    got = trie.prefix_trie(df).collect()
    own = {5: (("user", "x"), ("user", "x"), ("user", "y")), 6: (("", ""),), 7: (("", ""),)}
    assert sorted(map(str, map(text, got))) == sorted(map(str, plain_nodes(own, lambda t: len(t[1]))))
    assert trie.prefix_trie(df.where("false")).count() == 0


def test_query_against_sql(spark, testdata):
    sf = f"{testdata}/sf0.1"
    assert difference(op12_conversation_trie(spark, sf), connect(sf), ORACLES["op12_conversation_trie"]) is None
