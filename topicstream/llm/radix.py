"""An adaptive radix tree over byte strings, with path compression."""

from __future__ import annotations

from collections.abc import Iterator


class _Few:
    """Up to 4 or 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("bytes", "children", "limit")

    def __init__(self, limit: int = 4, labels: bytes = b"", children=()):
        self.limit, self.bytes, self.children = limit, bytearray(labels), list(children)

    def find(self, label: int):
        at = self.bytes.find(label)
        return None if at < 0 else self.children[at]

    def put(self, label: int, child) -> _Few | _Indexed:
        at = self.bytes.find(label)
        if at >= 0:
            self.children[at] = child
            return self
        if len(self.bytes) == self.limit:
            grown = _Few(16, self.bytes, self.children) if self.limit == 4 else _Indexed(self)
            return grown.put(label, child)
        at = sum(b < label for b in self.bytes)
        self.bytes.insert(at, label)
        self.children.insert(at, child)
        return self

    def in_order(self) -> Iterator:
        return iter(self.children)


class _Indexed:
    """Up to 48 children: for every byte the number of its slot, 0 for none."""

    __slots__ = ("slots", "children")

    def __init__(self, fewer: _Few):
        self.slots, self.children = bytearray(256), list(fewer.children)
        for slot, label in enumerate(fewer.bytes, 1):
            self.slots[label] = slot

    def find(self, label: int):
        slot = self.slots[label]
        return self.children[slot - 1] if slot else None

    def put(self, label: int, child) -> _Indexed | _Full:
        slot = self.slots[label]
        if slot:
            self.children[slot - 1] = child
            return self
        if len(self.children) == 48:
            return _Full(self).put(label, child)
        self.children.append(child)
        self.slots[label] = len(self.children)
        return self

    def in_order(self) -> Iterator:
        return (self.children[slot - 1] for slot in self.slots if slot)


class _Full:
    """A child for every byte."""

    __slots__ = ("children",)

    def __init__(self, fewer: _Indexed):
        self.children = [fewer.find(label) for label in range(256)]

    def find(self, label: int):
        return self.children[label]

    def put(self, label: int, child) -> _Full:
        self.children[label] = child
        return self

    def in_order(self) -> Iterator:
        return (child for child in self.children if child is not None)


class Node:
    """``path``: the bytes from the parent's end to this node's end. ``value``: that of the key which ends here, or None."""

    __slots__ = ("path", "value", "layout")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.layout = path, value, _Few()

    def children(self) -> Iterator[Node]:
        return self.layout.in_order()

    def put(self, child: Node) -> None:
        self.layout = self.layout.put(child.path[0], child)


class RadixTree:
    """Keys may be prefixes of one another, and the empty string is one like others."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        """Set the value of a key, which must not be None."""
        above, node, at = None, self.root, 0
        while True:
            same = _common(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same])
                above.put(upper)
                node.path = node.path[same:]
                upper.put(node)
                node = upper
            at += same
            if at == len(key):
                node.value = value
                return
            child = node.layout.find(key[at])
            if child is None:
                node.put(Node(key[at:], value))
                return
            above, node = node, child

    def from_below(self) -> Iterator[tuple[Node, int]]:
        """Every node after all nodes under it, with the depth in bytes where its path begins; siblings in byte order."""
        stack = [(self.root, 0, None)]
        while stack:
            node, top, rest = stack.pop()
            rest = node.children() if rest is None else rest
            child = next(rest, None)
            if child is None:
                yield node, top
            else:
                stack.append((node, top, rest))
                stack.append((child, top + len(node.path), None))


def _common(path: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``path`` the key has from ``at`` on."""
    if key.startswith(path, at):
        return len(path)
    same = 0
    for a, b in zip(path, memoryview(key)[at:]):
        if a != b:
            break
        same += 1
    return same
