"""Suffix-array dedup: bytes inside repeated byte strings are removed, by a range-partitioned sparse suffix array.

A byte goes if a string of `length` bytes around it also starts anywhere else. Suffixes are taken at anchors (one
for about every 100 windows, at the same place in every copy). Their leading tokens are the hash of the anchor's
gram and the hash of the run of windows the anchor stands for. Spark samples splitters and range-partitions the
suffixes by these tokens, with the place as last key, so that equal suffixes, however many, spread over buckets.
Buckets sort locally by token after token, and neighbours are compared: equal in both tokens, the whole run
repeats; equal in the first only, the group goes to a comparison of single windows, again range-partitioned and
sorted in the task. The first and last group of a bucket may go on in the next one; they are compared across
boundaries by one row per bucket and token pair.

Defined cases: a null text counts as empty; texts shorter than a window lose nothing; a match may begin and end
inside a character; rows with equal id and text count as two places, so both go; a string that repeats inside one
text goes too; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import HOT, SPANS, Units, collect, n_removed, pieces, run_rows, shared_windows, span_lists, with_covered
from .text import covered
from .work import stored

PLACE = ("doc_id", "mark", "start", "n")
#: What a bucket says of a suffix.
WHOLE, BRANCH, OPEN = 1, 2, 4


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffixes of a sorted bucket that repeat, or may."""
    table = collect(batches)
    if table is None:
        return
    key, span = table["key"].to_numpy(), table["span"].to_numpy()
    new_key = np.append(True, key[1:] != key[:-1])
    new_node = new_key | np.append(True, span[1:] != span[:-1])
    node = np.cumsum(new_node) - 1
    group = np.cumsum(new_key) - 1
    copies = np.bincount(node)[node]
    children = np.bincount(group[new_node])[group]
    state = np.where(copies > 1, WHOLE, 0) | np.where(new_node & (children > 1), BRANCH, 0)
    ends = (group == 0) | (group == group[-1])
    state[ends] = np.where(copies[ends] > 1, WHOLE, 0) | np.where(new_node[ends], OPEN, 0)
    some = pa.array(np.flatnonzero(state))
    out = table.take(some).append_column("state", pa.array(state[np.asarray(some)].astype(np.int32)))
    yield from out.combine_chunks().to_batches()


def repeated_runs(docs: DataFrame, units: Units, hot: int = HOT) -> DataFrame:
    """Runs (doc_id, mark, start, n) of windows that repeat."""
    suffixes = run_rows(docs, units)
    order = ("key", "span", "doc_id", "mark", "start")
    buckets = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(buckets.mapInArrow(_bucket, f"{_schema(suffixes)}, state int"), "buckets")
    # Across boundaries: of groups that are the first or the last of a bucket, one row per bucket and token pair.
    edge = found.where(F.col("state").bitwiseAND(OPEN) > 0)
    nodes = edge.groupBy("key", "span").agg(F.count("*").alias("buckets"), *(F.first(c).alias(c) for c in PLACE))
    alone = edge.where(F.col("state").bitwiseAND(WHOLE) == 0)
    met = alone.join(nodes.where("buckets > 1").select("key", "span"), ["key", "span"], "left_semi")
    forks = nodes.groupBy("key").agg(F.count("*").alias("children")).where("children > 1").select("key")
    met_branches = nodes.join(forks, "key", "left_semi").select(*PLACE, "key")

    whole = found.where(F.col("state").bitwiseAND(WHOLE) > 0).select(*PLACE).unionAll(met.select(*PLACE))
    branches = found.where(F.col("state").bitwiseAND(BRANCH) > 0).select(*PLACE, "key").unionAll(met_branches)
    return whole.unionAll(shared_windows(docs, stored(branches, "branches"), units, by_range=True, hot=hot))


def _schema(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _kept(length: int, data, offsets, row, start, n) -> dict[str, object]:
    gone = covered(offsets[row] + start, n + length - 1, len(data))
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(gone, out=total[1:])
    return {
        "n_bytes": np.diff(offsets), "kept": pieces(data[~gone], offsets - total[offsets], pa.binary()),
        "spans": span_lists(gone, offsets),
    }


def kept_bytes(docs: DataFrame, length: int = 400, gram: int = 200, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, kept (binary), spans (start, n) of the bytes removed."""
    units = Units(words=False, gram=gram, length=length)
    return with_covered(
        docs, repeated_runs(docs, units, hot), units, f"n_bytes bigint, kept binary, {SPANS}",
        lambda *chunk: _kept(length, *chunk),
    )


def dedup(docs: DataFrame, length: int = 400, gram: int = 200, hot: int = HOT) -> DataFrame:
    """Counts and digests of kept_bytes(): doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    n_spans = F.size("spans").cast("bigint").alias("n_spans")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept_bytes(docs, length, gram, hot).select("doc_id", "n_bytes", n_removed(), n_spans, digest)
