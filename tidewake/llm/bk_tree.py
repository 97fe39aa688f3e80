"""BK-trees over 64-bit fingerprints, many of them at a time.

A node's children are keyed by their Hamming distance to it. With a query at
distance ``d`` from a node, everything within ``radius`` of the query hangs on
edges ``d - radius`` to ``d + radius``; the other subtrees are not entered.

Trees of a batch form one forest of flat arrays. It grows and is searched level
by level for all its trees together, so small trees cost no call each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

# Distances are 0 to 64, so a node and an edge fit into one number.
_EDGES = 128

# Queries that descend at a time: bounds the pairs of query and node held in memory.
QUERIES = 512


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


@dataclass(frozen=True)
class Forest:
    """``values`` of all nodes, their ``parent`` (-1 for roots) and ``distance`` to it; ``roots`` by tree."""

    values: np.ndarray
    parent: np.ndarray
    distance: np.ndarray
    roots: np.ndarray

    def to_bytes(self) -> bytes:
        """A forest of one tree as bytes."""
        return b"".join((self.values.astype("<u8").tobytes(), self.parent.astype("<i4").tobytes(), self.distance.astype("u1").tobytes()))


def from_bytes(raw: bytes) -> Forest:
    n = len(raw) // 13
    return Forest(np.frombuffer(raw, "<u8", n), np.frombuffer(raw, "<i4", n, 8 * n).astype(np.int64),
                  np.frombuffer(raw, "u1", n, 12 * n).astype(np.int64), np.zeros(min(n, 1), np.int64))


def build(values: np.ndarray, sizes: np.ndarray) -> Forest:
    """Trees over runs of distinct ``values`` of the given positive sizes.

    The first value of a tree is its root. Values at one distance from a node go
    into one subtree, whose first value is the child: the tree that inserting
    the values one by one gives.
    """
    parent, distance = np.full(len(values), -1, np.int64), np.zeros(len(values), np.int64)
    waiting, group = np.arange(len(values)), np.repeat(np.arange(len(sizes)), sizes)
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else np.empty(0, np.int64)
    above = None
    while len(waiting):
        first = np.diff(group, prepend=-1) != 0
        node = waiting[first]
        if above is not None:
            parent[node], distance[node] = np.divmod(group[first], _EDGES)
        above = node[np.cumsum(first) - 1]
        edge = above * _EDGES + distances(values[waiting], values[above])
        waiting, edge = waiting[~first], edge[~first]
        order = np.argsort(edge, kind="stable")
        waiting, group = waiting[order], edge[order]
    return Forest(values, parent, distance, roots)


def search(forest: Forest, queries: np.ndarray, trees: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of query and node at most ``radius`` apart, some at a time; query ``i`` asks tree ``trees[i]``."""
    children = np.flatnonzero(forest.parent >= 0)
    edges = forest.parent[children] * _EDGES + forest.distance[children]
    order = np.argsort(edges, kind="stable")
    children, edges = children[order], edges[order]
    for start in range(0, len(queries), QUERIES):
        query = np.arange(start, min(start + QUERIES, len(queries)))
        node = forest.roots[trees[query]]
        while len(query):
            apart = distances(queries[query], forest.values[node])
            hit = apart <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(edges, node * _EDGES + np.maximum(apart - radius, 0))
            many = np.searchsorted(edges, node * _EDGES + apart + radius, "right") - low
            skipped = np.cumsum(many) - many
            query = np.repeat(query, many)
            node = children[np.repeat(low - skipped, many) + np.arange(len(query))]


def groups(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` things the least one that pairs connect it with. Pairs are taken one lot at a time and not kept."""
    label = np.arange(n)
    for x, y in pairs:
        while True:
            a, b = label[x], label[y]
            open_ = a != b
            if not open_.any():
                break
            x, y, a, b = x[open_], y[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label = label[label]
    return label
