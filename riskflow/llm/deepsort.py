"""Deep-shallow sorting of many groups of short byte strings.

The shallow part is a multikey sort on symbols of 8 bytes down to a fixed depth: at each depth only strings that are still tied
are sorted again. What is tied below that depth shares a long prefix; a blind trie then orders each such group: it branches on
single bytes, an insertion compares with one leaf only, and equal strings share a leaf.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8
#: Symbols compared before the tries take over.
SHALLOW = 2


def _differs(a: bytes, b: bytes) -> int:
    """The first place where two strings of one length differ; their length if nowhere."""
    if a == b:
        return len(a)
    x = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (x.bit_length() + 7) // 8


class BlindTrie:
    """Strings of one length by number. A node is [depth, branches by byte], a leaf the list of equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list = [0]
        for i in range(1, len(strings)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        own, at = self.strings[i], self.root
        while len(at) == 2 and isinstance(at[1], dict):
            at = at[1].get(own[at[0]]) or next(iter(at[1].values()))
        other = self.strings[at[0]]
        depth = _differs(own, other)
        if depth == len(own):
            at.append(i) if len(at) != 1 else at.extend((None, i))
            return
        above, byte, here = None, 0, self.root
        while len(here) == 2 and isinstance(here[1], dict) and here[0] < depth:
            above, byte = here, own[here[0]]
            here = here[1][byte]
        if len(here) == 2 and isinstance(here[1], dict) and here[0] == depth:
            here[1][own[depth]] = [i]
            return
        node = [depth, {other[depth]: here, own[depth]: [i]}]
        if above is None:
            self.root = node
        else:
            above[1][byte] = node

    def ordered(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            at = stack.pop()
            if len(at) == 2 and isinstance(at[1], dict):
                stack.extend(at[1][b] for b in sorted(at[1], reverse=True))
            else:
                # A leaf of equal strings: [first, None, second, third, ...].
                out.append(at[0])
                out.extend(at[2:])
        return out


def deep_shallow(groups: np.ndarray, keys: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``keys`` (bytes, width a multiple of 8) within ``groups`` (numbers), and the length of the prefix
    each row shares with the one before it; -1 where a group begins."""
    n, width = keys.shape
    symbols = np.ascontiguousarray(keys).view(">u8").astype(np.uint64)
    order = np.argsort(groups, kind="stable")
    # tied[p]: place p holds a row that is tied with the one at p - 1.
    tied = np.zeros(n, bool)
    tied[1:] = groups[order[1:]] == groups[order[:-1]]
    for depth in range(min(shallow, width // SYMBOL)):
        open_ = tied.copy()
        open_[:-1] |= tied[1:]
        places = np.flatnonzero(open_)
        if not len(places):
            break
        rows, part = order[places], np.cumsum(~tied[places])
        sub = np.lexsort((symbols[rows, depth], part))
        order[places] = rows[sub]
        same = symbols[order[1:], depth] == symbols[order[:-1], depth]
        tied[1:] &= same
    deep = min(shallow, width // SYMBOL) * SYMBOL
    if deep < width and tied.any():
        starts = np.flatnonzero(~tied & np.append(tied[1:], False))
        ends = np.flatnonzero(tied & ~np.append(tied[1:], False)) + 1
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            rows = order[lo:hi]
            trie = BlindTrie([keys[r, deep:].tobytes() for r in rows])
            order[lo:hi] = rows[trie.ordered()]
    shared = np.full(n, -1, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        apart = keys[a] != keys[b]
        shared[1:] = np.where(apart.any(1), apart.argmax(1), width)
        shared[1:][groups[a] != groups[b]] = -1
    return order, shared
