"""Deep-shallow sorting of byte strings in groups.

Strings are first sorted by their group and a few bytes, eight at a time
(multikey sorting with eight-byte characters, over arrays). Strings that agree
to that depth have long common prefixes; each such run is put in order by a
blind trie, which looks only at the branching bytes on the way down and compares
with one string per insertion.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    differ = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class _Leaf:
    __slots__ = ("text", "rows")

    def __init__(self, text: bytes, row: int):
        self.text, self.rows = text, [row]


class _Branch:
    __slots__ = ("depth", "ways")

    def __init__(self, depth: int, ways: dict):
        self.depth, self.ways = depth, ways


class BlindTrie:
    """Sorts strings by inserting them; the end of a string sorts before any byte."""

    def __init__(self):
        self.root: _Leaf | _Branch | None = None

    def insert(self, row: int, text: bytes) -> None:
        if self.root is None:
            self.root = _Leaf(text, row)
            return
        node = self.root
        while isinstance(node, _Branch):
            way = node.ways.get(text[node.depth] if node.depth < len(text) else -1)
            node = way if way is not None else next(iter(node.ways.values()))
        depth = common_prefix(text, node.text)
        if depth == len(text) == len(node.text):
            node.rows.append(row)
            return
        seen = node.text
        above, node = None, self.root
        while isinstance(node, _Branch) and node.depth < depth:
            above, node = node, node.ways[text[node.depth]]
        key = text[depth] if depth < len(text) else -1
        if isinstance(node, _Branch) and node.depth == depth:
            node.ways[key] = _Leaf(text, row)
            return
        branch = _Branch(depth, {key: _Leaf(text, row), seen[depth] if depth < len(seen) else -1: node})
        if above is None:
            self.root = branch
        else:
            above.ways[text[above.depth]] = branch

    def in_order(self) -> tuple[list[int], list[int]]:
        """Rows in order, and the common prefix of each with the one before (the first: 0)."""
        rows, common = [], []
        stack: list[tuple[_Leaf | _Branch, int]] = [(self.root, 0)] if self.root is not None else []
        while stack:
            node, shared = stack.pop()
            if isinstance(node, _Leaf):
                rows += node.rows
                common += [shared] + [len(node.text)] * (len(node.rows) - 1)
                continue
            ways = [node.ways[k] for k in sorted(node.ways)]
            stack += [(w, node.depth) for w in reversed(ways[1:])]
            stack.append((ways[0], shared))
        return rows, common


def shallow_order(groups: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and the words of each row, and where rows differ from the one before.

    Rows are partitioned by one word at a time; only runs that are still equal go
    on to the next word.
    """
    order = np.argsort(groups, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = groups[order][1:] != groups[order][:-1]
    for word in words.T:
        alone = new & np.append(new[1:], True)
        at = np.flatnonzero(~alone)
        if not len(at):
            break
        run = np.cumsum(new)[at]
        rows = order[at]
        rows = rows[np.lexsort((word[rows], run))]
        order[at] = rows
        new[at[1:]] |= word[rows][1:] != word[rows][:-1]
    return order, new


def sort_strings(groups: np.ndarray, texts: list[bytes], skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Order by group and string, and the common prefix of each with the one before.

    Across groups the common prefix is -1. The strings of a group agree in their
    first ``skip`` bytes.
    """
    head = b"".join(t[skip : skip + SHALLOW].ljust(SHALLOW, b"\0") for t in texts)
    words = np.frombuffer(head, ">u8").reshape(len(texts), SHALLOW // 8)
    order, new = shallow_order(groups, words)
    sorted_groups = groups[order]
    common = np.full(len(order), -1, np.int64)
    first = np.flatnonzero(new)
    for start, stop in zip(first.tolist(), np.append(first[1:], len(order)).tolist()):
        if stop - start > 1:
            trie = BlindTrie()
            for row in order[start:stop].tolist():
                trie.insert(row, texts[row])
            order[start:stop], common[start:stop] = trie.in_order()
        common[start] = (
            common_prefix(texts[order[start - 1]], texts[order[start]])
            if start and sorted_groups[start - 1] == sorted_groups[start]
            else -1
        )
    return order, common
