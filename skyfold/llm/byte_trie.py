"""Double-array tries over byte strings, walked by numpy for many positions at once.

A state is a slot of two arrays: the child of state ``s`` by byte ``b`` is the
slot ``base[s] + b`` if ``check`` of that slot is ``s``.  The root is slot 0.
``accept[s]`` is the number of the string that ends in ``s``, or -1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOT = 0
#: Nodes with more children than this get a range of slots of their own, whose
#: gaps other nodes fill.
WIDE = 16


@dataclass
class ByteTrie:
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray

    def state_of(self, prefix: bytes) -> int:
        """The state after ``prefix``, or -1."""
        s = ROOT
        for b in prefix:
            nxt = int(self.base[s]) + b
            if self.check[nxt] != s:
                return -1
            s = nxt
        return s

    def accepted(self, buf: np.ndarray, first: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Per position: the number of the string that equals ``buf[first:end]``
        walked from ``state`` (-1: no walk), or -1.  All positions advance together,
        one byte a step; ``end > first``."""
        out = np.full(len(first), -1, dtype=np.int64)
        at = np.flatnonzero(state >= 0)
        pos, stop, state = first[at], end[at], state[at]
        while len(at):
            nxt = self.base[state] + buf[pos]
            ok = self.check[nxt] == state
            at, pos, stop, state = at[ok], pos[ok] + 1, stop[ok], nxt[ok]
            done = pos == stop
            if done.any():
                out[at[done]] = self.accept[state[done]]
                on = ~done
                at, pos, stop, state = at[on], pos[on], stop[on], state[on]
        return out


def _nodes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, byte, end of string) of the trie's nodes in breadth-first order,
    node 0 being the root; ``strings`` are distinct, sorted and not empty."""
    n = len(strings)
    lens = np.array([len(s) for s in strings], dtype=np.int64)
    off = np.concatenate([[0], np.cumsum(lens)])
    raw = np.frombuffer(b"".join(strings), dtype=np.uint8)
    parents, labels, ends = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], np.full(n, -1, dtype=np.int64)
    alive, node, count = np.arange(n), np.zeros(n, dtype=np.int64), 1
    depth = 0
    while len(alive):
        b = raw[off[alive] + depth].astype(np.int64)
        new = np.ones(len(alive), dtype=bool)  # sorted strings: equal prefixes are neighbours
        new[1:] = (node[1:] != node[:-1]) | (b[1:] != b[:-1])
        parents.append(node[new])
        labels.append(b[new])
        node = count + np.cumsum(new) - 1
        count += int(new.sum())
        depth += 1
        done = lens[alive] == depth
        ends[alive[done]] = node[done]
        alive, node = alive[~done], node[~done]
    return np.concatenate(parents), np.concatenate(labels), ends


def place(kids: np.ndarray, first: np.ndarray, label: np.ndarray, width: int) -> np.ndarray:
    """Bases of nodes so that no two edges share a slot: node v has the edges
    ``first[v]`` to ``first[v] + kids[v]``, with rising labels below ``width``;
    the edge's slot is the base plus its label, and slot 0 stays free.

    Nodes with many edges get ranges of their own; the others are placed
    together, those with more edges first: every one proposes a base, those
    whose slots are free and not proposed twice are taken, the rest proposes again."""
    n = len(kids)
    base = np.zeros(n, dtype=np.int64)
    inner = np.flatnonzero(kids)
    wide = inner[kids[inner] > WIDE]
    low, high = label[first[wide]], label[first[wide] + kids[wide] - 1]
    starts = width + np.concatenate([[0], np.cumsum(high - low + 1)]).astype(np.int64)
    base[wide] = starts[:-1] - low
    used = np.zeros(int(starts[-1]) + 2 * n + width + 1024, dtype=bool)
    used[0] = True
    of = np.repeat(np.arange(len(wide)), kids[wide])
    step = np.arange(len(of)) - np.repeat(np.cumsum(kids[wide]) - kids[wide], kids[wide])
    used[base[wide][of] + label[first[wide][of] + step]] = True
    rng = np.random.default_rng(n)
    for most, least in ((WIDE, 9), (8, 5), (4, 3), (2, 1)):
        rest = inner[(kids[inner] <= most) & (kids[inner] >= least)]
        while len(rest):
            b = rng.integers(0, len(used) - width, len(rest))
            owner = np.repeat(np.arange(len(rest)), kids[rest])
            step = np.arange(len(owner)) - np.repeat(np.cumsum(kids[rest]) - kids[rest], kids[rest])
            slot = b[owner] + label[first[rest][owner] + step]
            order = np.argsort(slot, kind="stable")
            twice = np.zeros(len(slot), dtype=bool)
            twice[order[1:]] = slot[order[1:]] == slot[order[:-1]]
            bad = np.zeros(len(rest), dtype=bool)
            bad[owner[twice | used[slot]]] = True
            base[rest[~bad]] = b[~bad]
            used[slot[~bad[owner]]] = True
            if bad.mean() > 0.9:
                used = np.concatenate([used, np.zeros(n + 1024, dtype=bool)])
            rest = rest[bad]
    return base


def build(strings: list[bytes]) -> ByteTrie:
    """The trie of distinct, sorted byte strings; string i is accepted as i."""
    if not strings:
        return ByteTrie(np.zeros(1, np.int32), np.full(257, -1, np.int32), np.full(257, -1, np.int32))
    parent, label, ends = _nodes(strings)
    n = len(parent)
    kids = np.bincount(parent[1:], minlength=n)
    first = 1 + np.concatenate([[0], np.cumsum(kids)[:-1]])  # breadth first: children are neighbours
    base = place(kids, first, label, 256)
    slots = np.zeros(n, dtype=np.int64)
    slots[1:] = base[parent[1:]] + label[1:]
    top = int(max(slots.max(), base.max())) + 257
    out = ByteTrie(np.zeros(top, np.int32), np.full(top, -1, np.int32), np.full(top, -1, np.int32))
    out.base[slots] = base
    out.check[slots[1:]] = slots[parent[1:]]
    out.accept[slots[ends]] = np.arange(len(strings))
    return out
