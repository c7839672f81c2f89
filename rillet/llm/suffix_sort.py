"""Deep-shallow sorting of byte strings with long common prefixes."""

from dataclasses import dataclass, field

import numpy as np

#: Bytes compared at a time by the shallow sort.
WORD = 8


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, which is known to be at least ``start``."""
    size = min(len(a), len(b))
    if a[start:size] == b[start:size]:
        return size
    left, right = np.frombuffer(a, np.uint8, size - start, start), np.frombuffer(b, np.uint8, size - start, start)
    return start + int(np.argmax(left != right))


@dataclass
class _Node:
    """A branch at a depth: children by their byte there (-1 for a string that ends), in a blind trie."""

    depth: int
    children: dict = field(default_factory=dict)


def _byte(string: bytes, depth: int) -> int:
    return string[depth] if depth < len(string) else -1


def blind_trie_order(strings: list[bytes], members: list[int], depth: int) -> list[int]:
    """The members in order; all share their first ``depth`` bytes.

    The way down the trie looks at one byte per branch only.  It ends at a string that has the longest
    common prefix with the new one of all, and one comparison with that gives the place of the new branch.
    """
    root: _Node | list = [members[0]]
    for new in members[1:]:
        node, string = root, strings[new]
        while isinstance(node, _Node):
            node = node.children.get(_byte(string, node.depth)) or next(iter(node.children.values()))
        common = common_prefix(string, strings[node[0]], depth)
        if common == len(string) == len(strings[node[0]]):
            node.append(new)
            continue
        other, parent, node = strings[node[0]], None, root
        while isinstance(node, _Node) and node.depth < common:
            parent, node = node, node.children[_byte(string, node.depth)]
        if isinstance(node, _Node) and node.depth == common:
            node.children[_byte(string, common)] = [new]
            continue
        branch = _Node(common, {_byte(other, common): node, _byte(string, common): [new]})
        if parent is None:
            root = branch
        else:
            parent.children[_byte(string, parent.depth)] = branch
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, _Node):
            waiting.extend(node.children[key] for key in sorted(node.children, reverse=True))
        else:
            order.extend(node)
    return order


def deep_shallow_order(strings: list[bytes], depth: int = 0, shallow: int = 32) -> list[int]:
    """The numbers of the strings in order; all share their first ``depth`` bytes.

    Multikey quicksort on words of eight bytes splits the strings until they differ or share ``shallow``
    bytes more; blind tries order what is left.
    """
    limit = depth + shallow
    order: list[int] = []
    waiting = [(list(range(len(strings))), depth)]
    while waiting:
        members, at = waiting.pop()
        if len(members) < 2:
            order.extend(members)
        elif at >= limit:
            order.extend(blind_trie_order(strings, members, at))
        else:
            # A word with its length: a string that ends comes before those that go on.
            words = {n: (strings[n][at : at + WORD], len(strings[n]) - at >= WORD) for n in members}
            pivot = words[members[len(members) // 2]]
            less = [n for n in members if words[n] < pivot]
            same = [n for n in members if words[n] == pivot]
            more = [n for n in members if words[n] > pivot]
            waiting.append((more, at))
            waiting.append((same, at + WORD if pivot[1] else limit))
            waiting.append((less, at))
    return order
