"""An adaptive radix tree over byte strings: inner nodes grow from 4 to 16, 48 and 256 places, and single paths are compressed."""

from __future__ import annotations

from collections.abc import Iterator


class Sorted4:
    """Up to `room` children in two parallel lists, by byte."""

    room = 4
    __slots__ = ("bytes", "nodes")

    def __init__(self):
        self.bytes, self.nodes = bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node) -> bool:
        """Set a child; False if there is no place for another one."""
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return True
        if len(self.bytes) == self.room:
            return False
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return True

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.bytes, self.nodes)


class Sorted16(Sorted4):
    room = 16
    __slots__ = ()


class Indexed48:
    """Up to 48 children behind an index of 256 bytes; 255 marks a free byte."""

    room = 48
    __slots__ = ("index", "nodes")

    def __init__(self):
        self.index, self.nodes = bytearray(b"\xff" * 256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.nodes[at] if at != 255 else None

    def put(self, byte: int, node) -> bool:
        at = self.index[byte]
        if at != 255:
            self.nodes[at] = node
        elif len(self.nodes) == self.room:
            return False
        else:
            self.index[byte] = len(self.nodes)
            self.nodes.append(node)
        return True

    def items(self):
        return ((b, self.nodes[at]) for b, at in enumerate(self.index) if at != 255)


class Direct256:
    """A place for every byte."""

    room = 256
    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> bool:
        self.nodes[byte] = node
        return True

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


LARGER = {Sorted4: Sorted16, Sorted16: Indexed48, Indexed48: Direct256}


class Node:
    """The bytes that lead here from the node above, the values of keys that end here, and children."""

    __slots__ = ("path", "ends", "children")

    def __init__(self, path: bytes):
        self.path, self.ends, self.children = path, [], None

    def child(self, byte: int):
        return self.children.get(byte) if self.children is not None else None

    def attach(self, node: Node) -> None:
        if self.children is None:
            self.children = Sorted4()
        while not self.children.put(node.path[0], node):
            larger = LARGER[type(self.children)]()
            for b, n in self.children.items():
                larger.put(b, n)
            self.children = larger

    def below(self) -> list[Node]:
        return [n for _, n in self.children.items()] if self.children is not None else []


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] == b[:low], a[:high] != b[:high]
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


class Tree:
    def __init__(self):
        self.root = Node(b"")

    def add(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.ends.append(value)
                return
            below = node.child(key[at])
            if below is None:
                below = Node(key[at:])
                below.ends.append(value)
                node.attach(below)
                return
            shared = common(below.path, key[at : at + len(below.path)])
            if shared < len(below.path):  # the path forks, or the key ends within it
                fork = Node(below.path[:shared])
                below.path = below.path[shared:]
                fork.attach(below)
                node.attach(fork)
                below = fork
            node, at = below, at + shared
