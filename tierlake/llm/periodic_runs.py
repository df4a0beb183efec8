"""Periodic runs of words, by online dyadic square catching.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at least `powers` * q and
`least` words that no neighbour extends. The words of a text are appended one at a time:

- Each time a block of 1, 2, 4, ... words that is aligned to its size is complete, a catcher is set on it. The catcher
  of a block of size s lives while the appended word stands s to 2s - 1 words behind the block's end, so each size has
  one catcher at a time, and a square of a period p in that range cannot pass without meeting one.
- An appended word that equals the block's last word, p words back, starts a suffix comparison: the text's suffix is
  compared with the one that ends at the block, backwards over the block and beyond, as far as both agree. If they
  agree in p words, a square of period p is caught and the comparison stays under way: each further word that equals
  the one p words back advances it and reports the next square, which merges with those before into one run; another
  word ends it. A run of at least four periods holds such a moment: for 2p words a square ends at each of them.
- A period is not begun where an open run of a smaller period covers its square, and of runs over the same words the
  smallest period stays.

Before that, numpy sets aside words that are in no run: each word of a run but the last q stands again at most q words
on, and there are (powers - 1) * q such words side by side. Stretches that are too short for the distances in them
shrink until nothing changes; only what is left, with the words behind it, is appended. This loses no run.

Every text is looked at alone, so the job is a single pass without a shuffle; a task holds a chunk of texts. Words are
compared by numbers given to their bytes, not by hashes.

Defined cases: a null or empty text, or one of separators only, has no words and no runs; equal texts get equal rows;
rows without an id are treated like others; an empty table gives an empty result; other columns are ignored unless
named in `keep`. A very long text is one task's work: time and memory grow in proportion to it, but for texts made to
agree over long stretches without being periodic, where comparisons add up.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import Words, covered, map_texts


@dataclass(frozen=True)
class Runs:
    """Smallest length of a run, in periods and in words; powers is 3 at least."""

    powers: int = 4
    least: int = 6


def candidates(number: np.ndarray, bounds: np.ndarray, rules: Runs) -> list[tuple[int, int, int]]:
    """(first, last, end): spans of words that may hold runs which start in first..last; every run lies in one, whole."""
    n = len(number)
    if n < rules.least:
        return []
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = row * (int(number.max()) + 1) + number
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    where = order[:-1][same]
    gap = order[1:][same] - where
    back = np.argsort(where)
    where, gap = where[back], gap[back]  # words that stand again in their text, and how far on
    while len(where):
        new = np.append(True, (where[1:] != where[:-1] + 1) | (row[where[1:]] != row[where[:-1]]))
        start = np.flatnonzero(new)  # of stretches that stand side by side in one text
        size = np.diff(np.append(start, len(where)))
        period = size // (rules.powers - 1)
        enough = size >= np.maximum(rules.least - period, rules.powers - 1)
        limit = np.repeat(np.where(enough, period, 0), size)
        stay = gap <= limit
        if stay.all():
            first = where[start]
            behind = np.minimum(first + size + period, bounds[row[first] + 1])
            return list(zip(first.tolist(), (first + size - 1).tolist(), behind.tolist()))
        where, gap = where[stay], gap[stay]
    return []


def _agree(data: bytes, end: int, at: int) -> int:
    """How many words up to both places are equal, from there backwards: in doubling steps, then by halves."""

    def same(done: int, more: int) -> bool:
        a, b = 4 * (end + 1 - done), 4 * (at + 1 - done)
        return data[a - 4 * more : a] == data[b - 4 * more : b]

    done, step = 0, min(8, end + 1)
    while step and same(done, step):
        done += step
        step = min(2 * step, end + 1 - done)
    least, most = 0, max(step - 1, 0)
    while least < most:
        middle = (least + most + 1) // 2
        if same(done, middle):
            least = middle
        else:
            most = middle - 1
    return done + least


def catch(number: np.ndarray, rules: Runs) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text, by start and period."""
    words = number.tolist()
    data = number.astype(np.int32).tobytes()
    open_runs: dict[int, int] = {}  # period -> first word of the comparison that is under way
    found: dict[tuple[int, int], int] = {}

    def close(period: int, start: int, end: int) -> None:
        if end - start >= max(rules.powers * period, rules.least):
            found[start, end] = min(period, found.get((start, end), period))

    for at, word in enumerate(words):
        if open_runs:
            over = [p for p in open_runs if words[at - p] != word]
            for p in over:
                close(p, open_runs.pop(p), at)
        size = 1
        while size <= (at + 1) >> 1:
            end = (at + 1 - size) // size * size - 1  # the completed block whose catcher lives now
            if words[end] == word:
                period = at - end
                first = at + 1 - 2 * period  # of the square that would end here
                # an open run of a smaller period over these words accounts for this one
                if first >= 0 and period not in open_runs and all(q > period or start > first for q, start in open_runs.items()):
                    agree = _agree(data, end, at)
                    if agree >= period:
                        open_runs[period] = end - agree + 1
            size *= 2
    for period, start in open_runs.items():
        close(period, start, len(words))
    return sorted((start, end - start, period) for (start, end), period in found.items())


def _measure(data: np.ndarray, offsets: np.ndarray, rules: Runs) -> dict[str, pa.Array]:
    words = Words(data, offsets)
    _, number = words.numbers()
    row, start, length, period = [], [], [], []
    for first, last, end in candidates(number, words.bounds, rules):
        for s, size, q in catch(number[first:end], rules):
            if first + s <= last:  # a later one is the next span's, and may be cut off here
                row.append(int(words.row[first]))
                start.append(first + s)
                length.append(size)
                period.append(q)
    row, start, length, period = (np.array(x, np.int64) for x in (row, start, length, period))
    order = np.lexsort((period, start))  # texts follow each other, so this is by text as well
    row, start, length, period = row[order], start[order], length[order], period[order]
    kept = ~covered(start + period, length - period, len(number)) if len(start) else np.ones(len(number), bool)
    # The kept words with one space between: their bytes, and the separator behind each but the last of a text.
    first, end, own = words.start[kept], words.end[kept], words.row[kept]
    inner = np.append(own[1:] == own[:-1], False) if len(own) else np.zeros(0, bool)
    text = np.append(data, np.uint8(0))
    text[end[inner]] = 0x20
    stay = covered(first, end - first + inner, len(data)) if len(first) else np.zeros(len(data), bool)
    cut = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stay, out=cut[1:])
    lists = pa.StructArray.from_arrays(
        [pa.array(start - words.bounds[row]), pa.array(length), pa.array(period)], names=["start", "length", "period"]
    )
    listed = np.searchsorted(row, np.arange(len(offsets))).astype(np.int32)
    return {
        "n_words": pa.array(words.count.astype(np.int64)),
        "runs": pa.ListArray.from_arrays(pa.array(listed), lists),
        "collapsed": pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(cut[offsets]), pa.py_buffer(np.ascontiguousarray(text[:-1][stay]))
        ).cast(pa.string()),
    }


def find(docs: DataFrame, rules: Runs = Runs(), text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row the kept columns, n_words, runs (start, length, period; by start, then period) and collapsed.

    collapsed is the text's words, one space between, without those that stand in a run behind its first period.
    """
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return map_texts(docs, text, list(keep), schema, lambda data, offsets: _measure(data, offsets, rules))
