"""Shared steps of the two repeat finders: runs of windows of all texts, comparison of single windows, and spans.

A place in the corpus is (doc_id, mark, start): mark is a hash of the text, so rows with one id and different texts
stay apart, and rows with equal id and text share their result. A unit is a word or a byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .anchors import runs
from .text import Words, byte_sums, chunks, sums, windows
from .work import stored

#: Runs below one gram beyond which a group is not compared in one task but dealt out window by window.
HOT = 20_000
#: Windows that a task compares at a time, about.
GROUP = 2_000_000


@dataclass(frozen=True)
class Units:
    """Windows of `length` units, compared below grams of `gram` units; in words or in bytes."""

    words: bool
    gram: int
    length: int

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums over the units of a chunk, and the bounds of its texts in units."""
        if not self.words:
            return byte_sums(data), offsets
        words = Words(data, offsets)
        return sums(words.hashes()), words.bounds


def mark() -> Column:
    return F.xxhash64("text").alias("mark")


def collect(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def run_rows(docs: DataFrame, units: Units) -> DataFrame:
    """A row per run of windows: doc_id, mark, start, n (windows), key (gram), span (all its units)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(0)):
                prefix, bounds = units.read(data, offsets)
                found = runs(prefix, bounds, units.gram, units.length)
                row = np.searchsorted(bounds, found.start, "right") - 1
                where = pa.array(at + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).take(where), batch.column(2).take(where),
                        pa.array((found.start - bounds[row]).astype(np.int32)), pa.array(found.count.astype(np.int32)),
                        pa.array(found.key.view(np.int64)), pa.array(found.span.view(np.int64)),
                    ],
                    names=["doc_id", "mark", "start", "n", "key", "span"],
                )

    schema = f"doc_id {kind}, mark bigint, start int, n int, key bigint, span bigint"
    return docs.select("text", "doc_id", mark()).mapInArrow(work, schema)


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column; null counts as empty."""
    length = np.asarray(column.value_lengths().fill_null(0))
    return length, np.asarray(column.flatten())


def _with_lists(docs: DataFrame, spans: DataFrame, columns: list[str], how: str) -> DataFrame:
    """The text, id and mark of each document beside lists of the columns of its spans."""
    grouped = spans.groupBy("doc_id", "mark").agg(*(F.collect_list(c).alias(f"{c}_list") for c in columns))
    grouped = grouped.withColumnsRenamed({"doc_id": "_id", "mark": "_mark"})
    base = docs.select("text", "doc_id", mark())
    joined = base.join(grouped, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), how)
    return joined.select("text", "doc_id", "mark", *(f"{c}_list" for c in columns))


def shared_windows(docs: DataFrame, few: DataFrame, units: Units, by_range: bool, hot: int = HOT) -> DataFrame:
    """Runs (doc_id, mark, start, n) of windows that also stand in another of the given runs with their key.

    few: the distinct runs of keys with several of them, (doc_id, mark, start, n, key). A key with at most `hot`
    of them is compared in the task that its hash or, by_range, its place among sampled splitters deals it to.
    A larger one is dealt out by the hash of the whole window.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    weights = few.groupBy("key").agg(F.count("*").alias("runs"), F.sum("n").alias("windows"))
    total = weights.agg(F.sum(F.when(F.col("runs") <= hot, F.col("windows")))).first()[0] or 0
    hot_keys = weights.where(F.col("runs") > hot).select(F.col("key").alias("_key"), F.lit(True).alias("is_hot"))
    few = few.join(hot_keys, F.col("key") == F.col("_key"), "left").withColumn("is_hot", F.col("is_hot").isNotNull())

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A text's runs are compared once: where rows with its id repeat it, its runs repeat as a whole already.
        seen = set()
        for batch in batches:
            places = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            fresh = [i for i, place in enumerate(places) if place not in seen and not seen.add(place)]
            if len(fresh) < len(places):
                batch = batch.take(pa.array(fresh, pa.int64()))
            for at, to, data, offsets in chunks(batch.column(0)):
                prefix, bounds = units.read(data, offsets)
                every = windows(prefix, units.length)
                part = batch.slice(at, to - at)
                length, start = lists(part.column(3))
                n, key, is_hot = (lists(part.column(i))[1] for i in (4, 5, 6))
                row = np.repeat(np.arange(to - at), length)
                first = bounds[row] + start
                where = pa.array(row)
                blobs = [every[a : a + k].tobytes() for a, k in zip(first.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1).take(where), part.column(2).take(where), pa.array(start.astype(np.int32)),
                        pa.array(key), pa.array(is_hot), pa.array(blobs, pa.binary()),
                    ],
                    names=["doc_id", "mark", "start", "key", "is_hot", "hashes"],
                )

    hashed = _with_lists(docs, few, ["start", "n", "key", "is_hot"], "inner").mapInArrow(
        hashes, f"doc_id {kind}, mark bigint, start int, key bigint, is_hot boolean, hashes binary"
    )
    out_schema = f"doc_id {kind}, mark bigint, start int, n int"
    names = ["doc_id", "mark", "start", "n"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = collect(batches)
        if table is None:
            return
        blobs = table["hashes"].to_pylist()
        n = np.array([len(b) // 8 for b in blobs])
        window = np.frombuffer(b"".join(blobs), np.uint64)
        key = np.repeat(table["key"].to_numpy(), n)
        order = np.lexsort((window, key))
        same = (window[order[1:]] == window[order[:-1]]) & (key[order[1:]] == key[order[:-1]])
        shared = np.zeros(len(window), bool)
        shared[order[1:]] = same
        shared[order[:-1]] |= same
        run = np.repeat(np.arange(len(n)), n)
        head = shared.copy()
        head[1:] &= ~(shared[:-1] & (run[1:] == run[:-1]))
        at = np.flatnonzero(head)
        if not len(at):
            return
        members = np.bincount(np.cumsum(head)[shared] - 1, minlength=len(at))
        begins = np.concatenate([[0], np.cumsum(n)[:-1]])
        where = pa.array(run[at])
        start = table["start"].to_numpy()[run[at]] + at - begins[run[at]]
        columns = [table[c].take(where).combine_chunks() for c in ("doc_id", "mark")]
        yield from pa.table(
            [*columns, pa.array(start.astype(np.int32)), pa.array(members.astype(np.int32))], names
        ).to_batches()

    small = hashed.where("NOT is_hot").drop("is_hot")
    n_tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // GROUP))
    small = (small.repartitionByRange(n_tasks, "key") if by_range else small.repartition(n_tasks, "key")).mapInArrow(compare, out_schema)
    if hot_keys.isEmpty():
        return small

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                blobs = part.column(4).to_pylist()
                n = np.array([len(b) // 8 for b in blobs])
                row = np.repeat(np.arange(len(n)), n)
                inner = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                where = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(where), part.column(1).take(where),
                        pa.array((part.column(2).to_numpy()[row] + inner).astype(np.int32)), part.column(3).take(where),
                        pa.array(np.frombuffer(b"".join(blobs), np.int64)),
                    ],
                    names=["doc_id", "mark", "start", "key", "window"],
                )

    single = hashed.where("is_hot").drop("is_hot").mapInArrow(
        spread, f"doc_id {kind}, mark bigint, start int, key bigint, window bigint"
    )
    twice = single.groupBy("key", "window").agg(F.count("*").alias("times")).where("times > 1").select("key", "window")
    large = single.join(stored(twice, "windows"), ["key", "window"], "left_semi").select("doc_id", "mark", "start", F.lit(1).alias("n"))
    return small.unionAll(large)


#: Removed spans of a text: the first unit and the number of units of each, in order.
SPANS = "spans array<struct<start:int,n:int>>"


def span_lists(gone: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """The maximal runs of units that go, by text; bounds are those of the texts in units."""
    edge = np.zeros(len(gone) + 1, bool)
    edge[bounds] = True
    before, after = np.append(False, gone), np.append(gone, False)
    head = np.flatnonzero(after & (~before | edge))
    tail = np.flatnonzero(before & (~after | edge))
    own = bounds[np.searchsorted(bounds, head, "right") - 1]
    values = [pa.array((head - own).astype(np.int32)), pa.array((tail - head).astype(np.int32))]
    return pa.ListArray.from_arrays(
        pa.array(np.searchsorted(head, bounds).astype(np.int32)), pa.StructArray.from_arrays(values, ["start", "n"])
    )


def pieces(data: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A binary or string array of the bytes between consecutive cuts."""
    offsets = pa.py_buffer(np.ascontiguousarray(cuts, np.int32))
    return pa.Array.from_buffers(kind, len(cuts) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])


def n_removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["n"]).alias("n_removed")


def with_covered(
    docs: DataFrame, spans: DataFrame, units: Units, schema: str,
    work: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], dict[str, object]],
) -> DataFrame:
    """One row per document: doc_id and what work(bytes, offsets, row, start, n) returns.

    row, start, n: the runs of windows that cover what is to go, by row of the chunk, in units of the text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(x.split()[0] for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(0)):
                part = batch.slice(at, to - at)
                length, start = lists(part.column(3))
                row = np.repeat(np.arange(to - at), length)
                made = work(data, offsets, row, start.astype(np.int64), lists(part.column(4))[1].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1)] + [x if isinstance(x, pa.Array) else pa.array(x) for x in made.values()], names=names
                )

    # Rows with equal id and text bring the same spans: one of each is enough for all of them.
    spans = spans.groupBy("doc_id", "mark", "start").agg(F.max("n").alias("n"))
    return _with_lists(docs, spans, ["start", "n"], "left").mapInArrow(run, f"doc_id {kind}, {schema}")
