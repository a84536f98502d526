"""An adaptive radix tree over byte keys: nodes for 4, 16, 48 or 256 children, with their common path held once.

A key may end inside another one: every node has place for a value of its own.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class Node:
    """A node with the path that leads to it after its first byte, its value, and its children by byte.

    Up to 16 children are two sorted rows, bytes and nodes; up to 48 a table from byte to place; more a row of 256.
    """

    __slots__ = ("path", "value", "size", "room", "bytes", "nodes")

    def __init__(self, path: bytes, value: Any = None) -> None:
        self.path, self.value = path, value
        self.size, self.room = 0, 4
        self.bytes, self.nodes = bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.room <= 16:
            at = bisect_left(self.bytes, byte)
            return self.nodes[at] if at < self.size and self.bytes[at] == byte else None
        if self.room == 48:
            return self.nodes[self.bytes[byte] - 1] if self.bytes[byte] else None
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> None:
        """Make ``node`` the child under ``byte``, in place of one that is there."""
        if self.child(byte) is not None:
            if self.room <= 16:
                self.nodes[bisect_left(self.bytes, byte)] = node
            else:
                self.nodes[self.bytes[byte] - 1 if self.room == 48 else byte] = node
            return
        if self.size == self.room:
            self.grow()
        if self.room <= 16:
            at = bisect_left(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
        elif self.room == 48:
            self.nodes.append(node)
            self.bytes[byte] = self.size + 1
        else:
            self.nodes[byte] = node
        self.size += 1

    def grow(self) -> None:
        """The next larger layout."""
        held = list(self.children())
        self.room = {4: 16, 16: 48, 48: 256}[self.room]
        if self.room == 48:
            self.bytes, self.nodes = bytearray(256), [node for _, node in held]
            for place, (byte, _) in enumerate(held):
                self.bytes[byte] = place + 1
        elif self.room == 256:
            self.bytes, self.nodes = bytearray(), [None] * 256
            for byte, node in held:
                self.nodes[byte] = node

    def children(self) -> Iterator[tuple[int, Node]]:
        """Bytes and children in the order of the bytes."""
        if self.room <= 16:
            yield from zip(self.bytes, self.nodes)
        elif self.room == 48:
            yield from ((byte, self.nodes[place - 1]) for byte, place in enumerate(self.bytes) if place)
        else:
            yield from ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


def common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low = 0
    while most - low > 1:
        half = (low + most) // 2
        if a[low:half] == b[low:half]:
            low = half
        else:
            most = half
    return low


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value: Any) -> None:
        """Put ``value`` (not None) under ``key``, in place of an earlier one."""
        above, edge, node, at = None, 0, self.root, 0
        while True:
            shared = common(node.path, key[at:at + len(node.path)])
            if shared < len(node.path):
                upper = Node(node.path[:shared])
                upper.put(node.path[shared], node)
                node.path = node.path[shared + 1:]
                if above is None:
                    self.root = upper
                else:
                    above.put(edge, upper)
                node = upper
            at += shared
            if at == len(key):
                node.value = value
                return
            below = node.child(key[at])
            if below is None:
                node.put(key[at], Node(key[at + 1:], value))
                return
            above, edge, node, at = node, key[at], below, at + 1

    def find(self, key: bytes) -> Any:
        node, at = self.root, 0
        while node is not None and key.startswith(node.path, at):
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = node.child(key[at]), at + 1
        return None

    def climb(self) -> Iterator[tuple[int, int, Node]]:
        """Every node after all nodes beneath it, with the depths in bytes of its parent (-1 at the root) and of itself."""
        stack = [(-1, len(self.root.path), self.root, False)]
        while stack:
            above, depth, node, seen = stack.pop()
            if seen:
                yield above, depth, node
            else:
                stack.append((above, depth, node, True))
                stack += [(depth, depth + 1 + len(below.path), below, False) for _, below in node.children()]
