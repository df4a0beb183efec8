"""Signature trees over token sets: nodes hold OR-combined bitmaps and size ranges.

A set of n tokens has a bitmap of 2n to 4n bits (a power of two), one bit per token, so sets that can be similar
by half or more have bitmaps of the same or of neighbouring widths; below that, of widths further apart. The wider is
folded to the narrower. Two sets share at most
the bits their bitmaps share, and as many tokens more as the smaller of their excesses (tokens less bits set). The
same bound holds for two nodes with their OR-combined bitmaps, their largest excesses, and their size ranges, and
a pair of nodes whose bound is too low for the smallest sizes is pruned with all pairs below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

LEAF = 32
FAN = 8


def width(n: np.ndarray) -> np.ndarray:
    """Bits of the bitmap of a set of n tokens."""
    return np.maximum(64, 2 ** np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))


def bitmaps(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> list[bytes]:
    """The bitmap of each set; row and token are ordered by row."""
    wide = width(n)
    begin = np.concatenate([[0], np.cumsum(wide)])
    flat = np.zeros(begin[-1], np.uint8)
    flat[begin[row] + (token & (wide[row] - 1).astype(np.uint64)).astype(np.int64)] = 1
    packed = np.packbits(flat, bitorder="little").tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


class Tree:
    """Levels of nodes over sets of one width, which come in the order of their sizes; level 0 is the sets."""

    def __init__(self, bits: np.ndarray, n: np.ndarray):
        excess = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, n, n, excess)]
        step = LEAF
        while len(self.levels[-1][1]) > 1 and (len(self.levels) == 1 or len(self.levels[-1][1]) > 1):
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(low), step)
            self.levels.append(
                (np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at))
            )
            step = FAN

    def folded(self) -> Tree:
        bits, n, _, _ = self.levels[0]
        half = bits.shape[1] // 2
        return Tree(bits[:, :half] | bits[:, half:], n)


def bound(a: tuple, b: tuple, percent: int) -> np.ndarray:
    """Whether the rows of two aligned node (or set) tables may hold sets of the similarity."""
    shared = np.bitwise_count(a[0] & b[0]).sum(-1, dtype=np.int64)
    most = np.minimum(shared + np.minimum(a[3], b[3]), np.minimum(a[2], b[2]))
    return most * (100 + percent) >= percent * (a[1] + b[1])


def _rows(level: tuple, at) -> tuple:
    return tuple(x[at] for x in level)


def traverse(a: Tree, b: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of leaves (ranges of sets, as index arrays) that survive the dual traversal; a is b: each pair once."""
    own = a is b
    depth = min(len(a.levels), len(b.levels)) - 1
    top_a, top_b = a.levels[depth], b.levels[depth]
    left, right = (x.ravel() for x in np.meshgrid(np.arange(len(top_a[1])), np.arange(len(top_b[1])), indexing="ij"))
    for level in range(depth, 0, -1):
        if own:
            keep = left <= right
            left, right = left[keep], right[keep]
        alive = [
            bound(_rows(a.levels[level], left[i : i + 4096]), _rows(b.levels[level], right[i : i + 4096]), percent)
            for i in range(0, len(left), 4096)
        ]
        alive = np.concatenate(alive) if alive else np.zeros(0, bool)
        left, right = left[alive], right[alive]
        if level == 1:
            break
        step = np.arange(FAN)
        left = np.repeat((left[:, None] * FAN + step)[:, :, None], FAN, 2).ravel()
        right = np.repeat((right[:, None] * FAN + step)[:, None, :], FAN, 1).ravel()
        inside = (left < len(a.levels[level - 1][1])) & (right < len(b.levels[level - 1][1]))
        left, right = left[inside], right[inside]
    size_a, size_b = len(a.levels[0][1]), len(b.levels[0][1])
    if depth == 0:
        yield np.arange(size_a), np.arange(size_b)
        return
    for x, y in zip(left.tolist(), right.tolist()):
        yield np.arange(x * LEAF, min(size_a, (x + 1) * LEAF)), np.arange(y * LEAF, min(size_b, (y + 1) * LEAF))


def similar(
    n: np.ndarray, bits: list[bytes], percent: int, side: np.ndarray | None = None,
    skip: Callable[[np.ndarray, np.ndarray], bool] | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that may have the similarity, by pairs of leaves; no such pair is missed.

    side: only pairs of different sides count. skip(rows, rows): whether the pairs of two leaves need not be shown.
    """
    wide = np.array([8 * len(b) for b in bits])
    before: list[tuple[int, np.ndarray, Tree]] = []
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == w)
        rows = rows[np.argsort(n[rows], kind="stable")]
        tree = Tree(np.frombuffer(b"".join(bits[i] for i in rows.tolist()), np.uint64).reshape(len(rows), -1), n[rows])
        meetings = [(rows, tree, rows, tree)]
        # A narrower tree stays as long as its largest set can be similar to the smallest of this width.
        before = [x for x in before if x[0] * 2 == w or 100 * int(n[x[1][-1]]) >= percent * int(n[rows[0]])]
        folded, narrow = tree, w
        for v, own, other in reversed(before):
            while narrow > v:
                folded, narrow = folded.folded(), narrow // 2
            meetings.append((own, other, rows, folded))
        before.append((w, rows, tree))
        for rows_a, a, rows_b, b in meetings:
            for x, y in traverse(a, b, percent):
                if skip is not None and skip(rows_a[x], rows_b[y]):
                    continue
                one, other = _rows(a.levels[0], x), _rows(b.levels[0], y)
                fits = bound(tuple(v[:, None] for v in one), tuple(v[None, :] for v in other), percent)
                if side is not None:
                    fits &= side[rows_a[x]][:, None] != side[rows_b[y]][None, :]
                i, j = np.nonzero(fits)
                i, j = rows_a[x[i]], rows_b[y[j]]
                if a is b:
                    i, j = i[i != j], j[i != j]
                    once = (i < j) | (x[0] != y[0])
                    i, j = i[once], j[once]
                if len(i):
                    yield i, j
