"""Repetition rules: characters inside duplicated word n-grams and lines, by rolling hashes in numpy.

Every rule looks at one text alone, so the job is a single pass without a shuffle. A hash collision
between different n-grams of one text would need two equal 64-bit values.

Defined cases: a null or empty text and a text of separators only have no words and fail the base rule;
equal texts get equal rows; an empty table gives an empty result; other columns are ignored by
repetition() and returned untouched by keep().
"""

from __future__ import annotations

from dataclasses import dataclass, field
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import LOWER, Words, again, chunks, covered, inside, map_texts, per_row, pieces_hash, sums, windows

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict; a text is kept while every share is at or below its limit.

    ngram_share: n-gram length in words -> largest share of word characters inside n-grams that occur
    more than once in the text. line_share: the same for lines that occur more than once.
    """

    min_words: int = 20
    base_length: int = 8
    base_percent: int = 30
    ngram_share: dict[int, float] = field(default_factory=lambda: {5: 0.40, 7: 0.36, 10: 0.32})
    line_share: float = 0.40


def _measure(data: np.ndarray, offsets: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    words = Words(data, offsets)
    point = (data & 0xC0) != 0x80
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum(point & ~words.gap, out=points[1:])
    word_chars = np.diff(points[offsets])
    size = points[words.end] - points[words.start]
    hashes = words.hashes()

    def duplicated(prefix: np.ndarray, row: np.ndarray, length: int) -> np.ndarray:
        fits = np.flatnonzero(inside(row, length))
        found = fits[again(row[fits], windows(prefix, length)[fits])]
        return covered(found, length, len(row))

    prefix = sums(hashes)
    in_base = duplicated(prefix, words.row, rules.base_length)
    out = {
        "n_words": words.count.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": per_row(SYMBOL[data], offsets),
    }
    # Lines: spans between line feeds and text bounds that hold a word.
    feed = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], feed + 1]))
    start = start[start < len(data)]
    end = np.minimum(np.append(start[1:], len(data)), len(data))
    stop = np.where((end > start) & (data[end - 1] == 10), end - 1, end) if len(start) else end
    chars = points[stop] - points[start]
    full = np.flatnonzero(chars > 0)
    line_row = np.searchsorted(offsets, start[full], "right") - 1
    line_hash = pieces_hash(data, start[full], stop[full])
    line_bounds = np.searchsorted(line_row, np.arange(len(offsets)))
    own = line_hash ^ (line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(own, return_index=True)
    later = np.ones(len(full), bool)
    later[first] = False
    out["n_dup_lines"] = per_row(later, line_bounds)
    out["n_repeat_words"] = per_row(in_base, words.bounds)
    out["base_failed"] = (out["n_words"] < rules.min_words) | (
        100 * out["n_repeat_words"] > rules.base_percent * out["n_words"]
    )

    total = np.maximum(word_chars, 1)
    kept = ~out["base_failed"]
    # Case is folded for the method's own shares, so that repeats in another case count too.
    prefix = sums(Words(LOWER[data], offsets).hashes())
    shares = {}
    for length, limit in rules.ngram_share.items():
        flags = duplicated(prefix, words.row, length)
        inner = np.zeros(len(size) + 1, np.int64)
        np.cumsum(np.where(flags, size, 0), out=inner[1:])
        shares[length] = np.diff(inner[words.bounds]) / total
        kept &= shares[length] <= limit
    repeated = np.zeros(len(full) + 1, np.int64)
    np.cumsum(np.where(again(line_row, line_hash), chars[full], 0), out=repeated[1:])
    line_share = np.diff(repeated[line_bounds]) / total
    out["kept"] = kept & (line_share <= rules.line_share)
    for length, share in shares.items():
        out[f"share_{length}"] = share
    out["share_lines"] = line_share
    return out


def repetition(docs: DataFrame, rules: Rules = Rules(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: base counts, the share of characters in repeats, and the verdict."""
    schema = f"{id_column} {docs.schema[id_column].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"
    schema += "".join(f", share_{n} double" for n in rules.ngram_share) + ", share_lines double"
    return map_texts(docs, text, [id_column], schema, lambda data, offsets: _measure(data, offsets, rules))


def keep(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text passes the rules."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(_measure(data, offsets, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)
