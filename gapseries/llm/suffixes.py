"""Order of strings by deep-shallow sorting, with the common prefix lengths of neighbours.

Multikey quicksort partitions by eight bytes at a time until groups share
``SHALLOW`` bytes beyond what all strings share. The groups that are left have
long common prefixes; a blind trie orders each: only branching depths and
characters are stored, a new string walks down blindly to some leaf, one
comparison with that leaf gives the true branching depth, and the walk from the
root finds where the edge is split.
"""

from __future__ import annotations

SHALLOW = 16
STEP = 8


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix; ``start`` bytes are known to agree."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "below")

    def __init__(self, depth: int):
        self.depth = depth          # bytes that all strings below share
        self.below = {}             # next byte (-1: none) -> node, or list of equal strings


def _key(text: bytes, depth: int) -> int:
    return text[depth] if depth < len(text) else -1


def blind_trie(texts: list[bytes], own: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of the strings ``own`` (indexes), which share ``depth`` bytes, and each one's common prefix with the one before."""
    root = None
    for i in own:
        text = texts[i]
        if root is None:
            root = [i]
            continue
        node = root
        while type(node) is _Node:                              # blind walk: whichever leaf
            node = node.below.get(_key(text, node.depth)) or next(iter(node.below.values()))
        other = texts[node[0]]
        same = common(text, other, depth)
        if same == len(text) == len(other):
            node.append(i)
            continue
        above, edge, node = None, 0, root
        while type(node) is _Node and node.depth < same:
            above, edge = node, _key(text, node.depth)
            node = node.below[edge]
        if type(node) is _Node and node.depth == same:
            node.below[_key(text, same)] = [i]
            continue
        split = _Node(same)
        split.below[_key(other, same)] = node
        split.below[_key(text, same)] = [i]
        if above is None:
            root = split
        else:
            above.below[edge] = split
    order, lcp, stack = [], [], [(root, depth)]
    while stack:
        node, same = stack.pop()
        if type(node) is _Node:
            below = sorted(node.below.items(), reverse=True)
            stack += [(child, node.depth) for _, child in below[:-1]]
            stack.append((below[-1][1], same))
        else:
            order += node
            lcp += [same] + [len(texts[node[0]])] * (len(node) - 1)
    return order, lcp


def deep_shallow(texts: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """``(order, lcp)``: indexes in byte order and each one's common prefix with the one before it (the first: 0)."""
    if not texts:
        return [], []
    shared = common(min(texts), max(texts))
    limit = shared + shallow
    order: list[int] = []
    lcp: list[int] = []
    stack = [(list(range(len(texts))), shared)]
    while stack:
        own, depth = stack.pop()
        if len(own) == 1 or depth >= limit:
            got, same = blind_trie(texts, own, depth)
            if order:
                same[0] = common(texts[order[-1]], texts[got[0]])
            else:
                same[0] = 0
            order += got
            lcp += same
            continue
        pivot = texts[own[len(own) // 2]][depth:depth + STEP]
        less, equal, more = [], [], []
        for i in own:
            key = texts[i][depth:depth + STEP]
            (equal if key == pivot else less if key < pivot else more).append(i)
        if more:
            stack.append((more, depth))
        # strings that end within this step are equal as a whole
        stack.append((equal, depth + STEP if len(pivot) == STEP else limit))
        if less:
            stack.append((less, depth))
    return order, lcp
