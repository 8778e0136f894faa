"""Union-find over the depths that neighbours of a sorted list share, on parts of the list that are joined afterwards.

A list has items (sequences, or nodes of their trie) and between neighbours an edge: how deep both go together. Edges are
taken in descending depth. Each joins two components, which meet in a node of that depth; what lies between a component's
top and that node is a chain without branches, and is final. Where the list is a part of a longer one, its first and last
item may go on together with what lies beyond. There only what hangs off the outer paths is closed, and the part
shrinks to these paths: their items, from the first one up and down again to the last. Such contracted parts are laid side
by side and treated alike, until one list without open ends is left.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass
from typing import NamedTuple


class Edge(NamedTuple):
    """A node on which two neighbours part: its depth, the code points up to it, and its prefix."""

    depth: int
    points: int
    prefix: tuple[int, int]


class Element(NamedTuple):
    """A step into a branch: the depth and prefix behind it, and the code points and prefix before it."""

    depth: int
    prefix: tuple[int, int]
    points_before: int
    before: tuple[int, int]


class Chain(NamedTuple):
    """Nodes of the depths ``low`` to ``high`` of conversation ``least``, with the values that they share.

    ``below`` is what the nodes under the last one save; ``children`` counts the last one's children.
    """

    least: int
    low: int
    high: int
    n: int
    leaves: int
    children: int
    below: int
    points: int
    prefix: tuple[int, int]
    parent: tuple[int, int]


@dataclass(slots=True)
class Item:
    """A node with all that is known to hang below it; its ways up are still open."""

    depth: int
    points: int
    prefix: tuple[int, int]
    n: int
    least: int
    children: int = 0
    leaves: int = 0
    below: int = 0

    def add(self, other: "Item", chains: list[Chain]) -> None:
        """Take in an item that is the same node, or hangs below this one; in that case its chain ends here."""
        self.n += other.n
        self.least = min(self.least, other.least)
        if other.depth == self.depth:
            self.children += other.children
            self.leaves += other.leaves
            self.below += other.below
            return
        leaves = other.leaves if other.children else 1
        chains.append(other.chain(self.depth + 1, self.prefix))
        self.children += 1
        self.leaves += leaves
        self.below += other.below + (other.n - 1) * (other.points - self.points)

    def chain(self, low: int, parent: tuple[int, int]) -> Chain:
        leaves = self.leaves if self.children else 1
        return Chain(self.least, low, self.depth, self.n, leaves, self.children, self.below, self.points, self.prefix, parent)


@dataclass(slots=True)
class Part:
    """Items of a stretch of the sorted list with the edges between them, and the keys of its first and last sequence."""

    items: list[Item]
    edges: list[Edge]
    first: list[Element]
    last: list[Element]


def edge_between(left: list[Element], right: list[Element]) -> Edge:
    """Where two neighbours part; the right one always goes on from there."""
    k = 0
    while k < len(left) and left[k].prefix == right[k].prefix and left[k].depth == right[k].depth:
        k += 1
    step = right[k]
    return Edge(step.depth - 1, step.points_before, step.before)


def side_by_side(left: Part, right: Part) -> Part:
    between = edge_between(left.last, right.first)
    return Part(left.items + right.items, [*left.edges, between, *right.edges], left.first, right.last)


@dataclass(slots=True)
class _Component:
    items: deque
    edges: deque
    first: bool  # holds the first item of an open part
    last: bool


def contract(part: Part, open_ends: bool = True) -> tuple[Part, list[Chain]]:
    """The part reduced to its outer paths (to one item if its ends are not open), and the chains that are final."""
    chains: list[Chain] = []
    n = len(part.items)
    component = [_Component(deque([x]), deque(), open_ends and k == 0, open_ends and k == n - 1) for k, x in enumerate(part.items)]
    parent = list(range(n))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in sorted(range(n - 1), key=lambda k: -part.edges[k].depth):
        edge, i, j = part.edges[k], find(k), find(k + 1)
        left, right = component[i], component[j]
        parent[j] = i
        component[i] = _join(left, right, edge, chains)
        component[j] = None
    whole = component[find(0)]
    return Part(list(whole.items), list(whole.edges), part.first, part.last), chains


def _join(left: _Component, right: _Component, edge: Edge, chains: list[Chain]) -> _Component:
    if left.first and right.last:
        left.items.extend(right.items)
        left.edges.append(edge)
        left.edges.extend(right.edges)
        left.last = True
        return left
    if right.last:
        if right.items[0].depth > edge.depth:
            right.items.appendleft(_node(edge))
            right.edges.appendleft(edge)
        right.items[0].add(left.items[0], chains)
        return right
    if left.items[-1].depth > edge.depth:
        if left.first:
            left.items.append(_node(edge))
            left.edges.append(edge)
        else:
            node = _node(edge)
            node.add(left.items[0], chains)
            left.items[0] = node
    left.items[-1].add(right.items[0], chains)
    return left


def _node(edge: Edge) -> Item:
    return Item(edge.depth, edge.points, edge.prefix, 0, 1 << 63)


def finish(part: Part) -> list[Chain]:
    """The remaining chains of the whole list, the last of them from the root on."""
    rest, chains = contract(part, open_ends=False)
    return [*chains, rest.items[0].chain(0, (0, 0))]
