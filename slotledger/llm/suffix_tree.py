"""Suffix trees of number sequences, and the longest common extension of two places.

``SuffixTree`` is built by Ukkonen's algorithm, one symbol after another. A tour of the
tree in the order of its edges' first symbols meets the leaves in the order of their
suffixes; of the nodes that the Euler tour passes between two neighbouring leaves only the
highest matters, their lowest common ancestor. So the tour is kept as one depth for each
two neighbouring leaves, and the ancestor of any two leaves is a range minimum over it,
answered from a table of doubling widths in constant time, for whole arrays of places.
"""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """Of ``symbols``, positive numbers, with the end marked by 0, lower than all of them."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        size, width = len(text), max(text) + 1
        start, stop, link, parent, suffix = [0], [0], [0], [0], [-1]
        child: dict[int, int] = {}  # node * width + symbol -> node

        def grow(begin: int, end: int, above: int, leaf: int) -> int:
            start.append(begin)
            stop.append(end)
            link.append(0)
            parent.append(above)
            suffix.append(leaf)
            return len(start) - 1

        node = edge = length = done = 0  # active point, and suffixes that have their leaf
        for i, symbol in enumerate(text):
            last = 0
            while done <= i:
                if not length:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = grow(i, size, node, done)
                    link[last] = node
                    last = 0
                else:
                    span = min(stop[below], i + 1) - start[below]
                    if length >= span:
                        edge, length, node = edge + span, length - span, below
                        continue
                    if text[start[below] + length] == symbol:
                        length += 1
                        link[last] = node
                        break
                    split = grow(start[below], start[below] + length, node, -1)
                    child[key] = split
                    child[split * width + symbol] = grow(i, size, split, done)
                    start[below] += length
                    parent[below] = split
                    child[split * width + text[start[below]]] = below
                    link[last] = split
                    last = split
                done += 1
                if node:
                    node = link[node]
                elif length:
                    length, edge = length - 1, done
            link[0] = 0
        self.size = size
        self.start, self.stop, self.parent, self.suffix = start, stop, parent, suffix
        self._first = np.array(text)[start]  # first symbol of the edge into each node

    def tour(self, descending: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and the depth where each two neighbours part.

        With ``descending`` symbols count in reverse order; the end stays the lowest.
        """
        order = np.where(self._first == 0, -self.size - 1, -self._first if descending else self._first)
        nodes = np.lexsort((-order[1:], np.array(self.parent)[1:])) + 1  # last child first
        bounds = np.searchsorted(np.array(self.parent)[nodes], np.arange(len(self.start) + 1)).tolist()
        children = nodes.tolist()
        start, stop, parent, suffix = self.start, self.stop, self.parent, self.suffix
        depth = [0] * len(start)
        leaves: list[int] = []
        parted: list[int] = []
        stack, at_leaf = [0], False
        while stack:
            node = stack.pop()
            above = depth[parent[node]]
            if at_leaf:
                parted.append(above)
            at_leaf = suffix[node] >= 0
            if at_leaf:
                leaves.append(suffix[node])
            else:
                depth[node] = above + stop[node] - start[node]
                stack += children[bounds[node] : bounds[node + 1]]
        return np.array(leaves), np.array(parted, dtype=np.int32)


def ranks(suffixes: np.ndarray) -> np.ndarray:
    """The place of each suffix in their order."""
    out = np.empty(len(suffixes), dtype=np.int64)
    out[suffixes] = np.arange(len(suffixes))
    return out


class Extension:
    """How many symbols agree from two places on."""

    def __init__(self, suffixes: np.ndarray, parted: np.ndarray):
        self._rank = ranks(suffixes)
        self._least = [parted]  # minima over 1, 2, 4, ... neighbours
        width = 1
        while 2 * width <= len(parted):
            lower = self._least[-1]
            self._least.append(np.minimum(lower[:-width], lower[width:]))
            width *= 2

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For places that differ, the end included."""
        a, b = self._rank[left], self._rank[right]
        first, count = np.minimum(a, b), np.abs(a - b)
        level = np.frexp(count)[1] - 1  # the largest power of two within
        out = np.empty(len(first), dtype=np.int64)
        for k in np.unique(level).tolist():
            own = np.flatnonzero(level == k)
            table, begin = self._least[k], first[own]
            out[own] = np.minimum(table[begin], table[begin + count[own] - (1 << k)])
        return out
