"""An adaptive radix tree over byte keys whose nodes keep totals at every ``width``-th byte.

Inner nodes hold their children in the smallest of four layouts and grow into the next one when full: up to 4 or 16 sorted
byte keys, an index of 256 bytes into 48 places, 256 places. Chains without a branch are compressed into
the bytes of one edge. Keys are fixed-width ids one after the other, so only depths that are a multiple of ``width`` mean anything: an
edge carries one totals object for each such depth in it, and a split deals them to both halves.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator


class Sorted:
    """Up to ``most`` children (4 or 16) by sorted byte."""

    __slots__ = ("most", "keys", "nodes")

    def __init__(self, most: int = 4):
        self.most, self.keys, self.nodes = most, bytearray(), []

    def get(self, byte: int):
        at = self.keys.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node) -> Sorted | Indexed:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.keys) == self.most == 16:
            grown = Indexed()
            for b, n in self:
                grown.put(b, n)
            return grown.put(byte, node)
        if len(self.keys) == self.most:
            self.most = 16
        self.keys.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self):
        return zip(self.keys, self.nodes)


class Indexed:
    """Up to 48 children behind an index of all bytes; 0 in the index is none."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node) -> Indexed | Full:
        if self.index[byte]:
            self.nodes[self.index[byte] - 1] = node
            return self
        if len(self.nodes) == 48:
            grown = Full()
            for b, n in self:
                grown.put(b, n)
            return grown.put(byte, node)
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return ((byte, self.nodes[at - 1]) for byte, at in enumerate(self.index) if at)


class Full:
    """A place for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> Full:
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


class Edge:
    """Compressed bytes that end at key depth ``end``, totals of the aligned depths in them, and the children below."""

    __slots__ = ("bytes", "end", "totals", "children")

    def __init__(self, edge: bytes, end: int, totals: list):
        self.bytes, self.end, self.totals, self.children = edge, end, totals, Sorted()


class RadixTree:
    """``new(depth)`` makes the totals of an aligned depth when a key first reaches it; depths count whole ids."""

    def __init__(self, width: int):
        self.width, self.root = width, Edge(b"", 0, [])

    def insert(self, key: bytes, new: Callable[[int], object], add: Callable[[object, int], None]) -> None:
        """Call ``add(totals, depth)`` for every aligned depth of ``key`` but the root's, nearest first."""
        width, edge, at = self.width, self.root, 0
        while at < len(key):
            below = edge.children.get(key[at])
            if below is None:
                first = at // width + 1
                fresh = Edge(key[at:], len(key), [new(d) for d in range(first, len(key) // width + 1)])
                edge.children = edge.children.put(key[at], fresh)
                below = fresh
            same = len(below.bytes)
            if not key.startswith(below.bytes, at):
                most = min(same, len(key) - at)
                same = next((k for k in range(most) if below.bytes[k] != key[at + k]), most)
                if at + same < len(key):
                    upper = self._split(below, same)
                    edge.children = edge.children.put(key[at], upper)
                    below = upper
            reached, first = at + same, at // width + 1
            for depth in range(first, reached // width + 1):
                add(below.totals[depth - first], depth)
            edge, at = below, reached

    def _split(self, edge: Edge, length: int) -> Edge:
        """The first ``length`` bytes of an edge as an edge above the rest of it."""
        begin = edge.end - len(edge.bytes)
        stay = (begin + length) // self.width - begin // self.width
        upper = Edge(edge.bytes[:length], begin + length, edge.totals[:stay])
        edge.bytes, edge.totals = edge.bytes[length:], edge.totals[stay:]
        upper.children = upper.children.put(edge.bytes[0], edge)
        return upper

    def totals(self) -> Iterator:
        """The totals of all aligned depths."""
        waiting = [self.root]
        while waiting:
            edge = waiting.pop()
            yield from edge.totals
            waiting += [node for _, node in edge.children]
