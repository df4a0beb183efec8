"""Substring dedup by prefix-partitioned, sparse suffix trees: words inside repeated passages are removed.

A word goes if a window of `length` words around it has a word sequence that also starts anywhere else. Only the
suffixes at anchors are taken (one for about every 12 windows, at the same place in every copy), and the levels
of their tree are built from the root by prefixes of growing length, each level from the nodes of the one before
that have at least two leaves:

1. nodes of depth `gram`: the anchor's words. A node with one leaf holds no repeat and is left.
2. nodes as deep as a whole run of windows (at least `length` words): two leaves make every window of the run a
   repeat, however many copies there are; counts are combined in map tasks, so copies never gather.
3. below a node of level 1 with several children: the subtree of single windows. A node of ordinary size is built
   in one task, many nodes to a task; a node with more than HOT runs is split by the longest prefix, the window.

A deep node with two leaves is a repeat, and the union of its places over all levels is what goes.

Defined cases: a null or empty text has no words; texts shorter than a window lose nothing; rows with equal id and
text count as two places, so both go; a passage that repeats inside one text goes too; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import HOT, SPANS, Units, n_removed, pieces, run_rows, shared_windows, span_lists, with_covered
from .text import Words, covered
from .work import stored


def repeated_runs(docs: DataFrame, units: Units, hot: int = HOT) -> DataFrame:
    """Runs (doc_id, mark, start, n) of windows that repeat."""
    suffixes = run_rows(docs, units)
    inner = suffixes.groupBy("key").agg(F.count("*").alias("leaves")).where("leaves > 1").select("key")
    # The nodes are written first: beside a read table Spark can split the rows of a hot prefix.
    below = stored(suffixes.join(stored(inner, "prefixes"), "key", "left_semi"), "suffixes")
    first = [F.first(c).alias(c) for c in ("doc_id", "mark", "start", "n")]
    nodes = below.groupBy("key", "span").agg(F.count("*").alias("leaves"), *first)
    deep = nodes.where("leaves > 1").select("key", "span")
    whole = below.join(stored(deep, "deep"), ["key", "span"], "left_semi").select("doc_id", "mark", "start", "n")
    forks = nodes.groupBy("key").agg(F.count("*").alias("children")).where("children > 1").select("key")
    branches = stored(nodes.join(forks, "key", "left_semi").select("doc_id", "mark", "start", "n", "key"), "branches")
    return whole.unionAll(shared_windows(docs, branches, units, by_range=False, hot=hot))


def _kept(length: int, data, offsets, row, start, n) -> dict[str, object]:
    words = Words(data, offsets)
    gone = covered(words.bounds[row] + start, n + length - 1, len(words.start))
    stay = np.flatnonzero(~gone)
    # The kept words one after the other, each with a space behind it but the last of a text.
    spaced = np.append(words.row[stay][1:] == words.row[stay][:-1], False)[: len(stay)]
    size = words.end[stay] - words.start[stay] + spaced
    place = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(place[-1]) + np.repeat(words.start[stay] - place[:-1], size)
    line = np.append(data, np.uint8(32))[source]
    line[place[1:][spaced] - 1] = 32
    cut = place[np.searchsorted(stay, words.bounds)]
    return {
        "n_words": words.count.astype(np.int64), "kept": pieces(line, cut, pa.string()),
        "spans": span_lists(gone, words.bounds),
    }


def kept_texts(docs: DataFrame, length: int = 35, gram: int = 12, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_words, kept (words joined by a space), spans (start, n) of the words removed."""
    units = Units(words=True, gram=gram, length=length)
    return with_covered(
        docs, repeated_runs(docs, units, hot), units, f"n_words bigint, kept string, {SPANS}",
        lambda *chunk: _kept(length, *chunk),
    )


def dedup(docs: DataFrame, length: int = 35, gram: int = 12, hot: int = HOT) -> DataFrame:
    """Counts and digests of kept_texts(): doc_id, n_words, n_removed, kept_sha256."""
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept_texts(docs, length, gram, hot).select("doc_id", "n_words", n_removed(), digest)
