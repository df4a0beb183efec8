"""Anchors: content-chosen positions that cut the windows of a text into short runs, the same in every copy.

The anchor of a window of `length` values is the place of its smallest gram of `gram` values (the first of
equals), which depends on the window alone. Windows of one text that share an anchor stand next to each other: a
run. Equal windows have equal anchor grams, so windows are compared only below one gram; and two runs with equal
values are equal window by window. This leaves about two rows for every (length - gram + 2) positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .text import U64, span_hash, windows


@dataclass(frozen=True)
class Runs:
    """start, count: first window of a run and number of windows; key: hash of the gram; span: of all its values."""

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    span: np.ndarray


def runs(prefix: np.ndarray, bounds: np.ndarray, gram: int, length: int) -> Runs:
    """The runs of all windows that stay between consecutive bounds; prefix: sums() of the values."""
    n = len(prefix) - 1
    if n < length:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(U64), none.astype(U64))
    grams = windows(prefix, gram)
    bits = int(n).bit_length()
    place = U64((1 << bits) - 1)
    least = (grams & ~place) | np.arange(len(grams), dtype=U64)
    width, reach = length - gram + 1, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    anchor = (least & place).astype(np.int64)
    size = np.diff(bounds)
    fits = np.zeros(n + 1, np.int64)
    wide = size >= length
    np.add.at(fits, bounds[:-1][wide], 1)
    np.add.at(fits, bounds[1:][wide] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(fits[: len(anchor)]) > 0)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Runs(none, none, none.astype(U64), none.astype(U64))
    own = anchor[start]
    head = np.ones(len(start), bool)
    head[1:] = (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)
    at = np.flatnonzero(head)
    count = np.diff(np.append(at, len(start)))
    first = start[at]
    return Runs(first, count, grams[own[at]], span_hash(prefix, first, first + count - 1 + length))
