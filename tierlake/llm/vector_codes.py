"""Product codes of vectors by member-resident Lloyd rounds in whole numbers.

Each vector's components become floor(scale * x) and are cut into equal consecutive parts; the parts of a position
share a codebook. A round assigns each part to the nearest entry of its codebook (squared Euclidean distance, the
lower of ties) and moves each entry to the floor of the mean of its parts.

Parts live with their owner, the holder of (position, entry, salt); salts bound an owner's members, so that an entry
which draws a third of all parts has many owners. The first round deals all parts out to their owners. From then on
a part stays in the file it was written to, and only the parts that change entry go through the next round's shuffle
to a new owner and into a new file. An owner needs no list of who has left: where a part has been follows from the
codebooks of the rounds since it came, which are small, so a member whose way led elsewhere is passed over. An entry's
sum and count stand with it: arrivals are added, departures taken off, exact in whole numbers. A round thus reads the
resident parts once and shuffles and writes the moving ones. Rounds end early once no part moves, as nothing would
change any more. The codes come from one more pass over the vectors with the last codebooks.

Through the driver go the codebooks and per-entry sums, entries * dimension numbers a round, whatever the input. The
files are in the shared folder, so lost executors cost a re-read.

Defined cases: vectors that are null or hold null or non-finite components, and empty ones, are dropped, and so are
those whose length is not that of the kept vector with the smallest id; that length must divide into the parts, else
an error is raised, as for components of 2**16 or more in size, whose distances would not fit a long (at the default
scale). First entries are the parts of the smallest distinct ids (of rows that share one, the smallest vector; rows
without id count as the last id); with fewer ids there are fewer entries. Repeated rows are coded each. An empty table
gives an empty result and empty codebooks. Rows without a label are one label. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored

#: Whole numbers of this size and beyond are refused; below the second, doubles hold distances exactly.
LIMIT, EXACT = 1 << 28, 1 << 22


@dataclass(frozen=True)
class Coding:
    """members: parts of a position that share a salt."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096
    members: int = 4096


def kept(vectors: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """id, x (array of doubles) and label of the vectors without missing or non-finite components."""
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & sound).select(
        F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("x"), F.col(label).alias("label")
    )


def whole(batch: pa.RecordBatch, dimension: int, coding: Coding) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch (id, x, label) that have the dimension, and their components as whole numbers."""
    column = batch.column(1)
    rows = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == dimension)
    x = np.floor(coding.scale * column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)).reshape(-1, dimension)
    if x.size and np.abs(x).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT // coding.scale} or more in size does not fit")
    return rows, x.astype(np.int64)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry; the lower index of ties."""
    if max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)) < EXACT:
        parts, book = parts.astype(np.float64), book.astype(np.float64)
    far = (parts * parts).sum(1)[:, None] - 2 * (parts @ book.T) + (book * book).sum(1)[None, :]
    entry = far.argmin(1)
    return entry, far[np.arange(len(parts)), entry].astype(np.int64)


def _deal(dimension: int, books: np.ndarray, salts: int, coding: Coding) -> Callable:
    """Every part with its first entry and a salt that runs through the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            rows, x = whole(batch, dimension, coding)
            salt = (seen + rows) % salts
            seen += batch.num_rows
            for position, parts in enumerate(np.split(x, coding.parts, axis=1)):
                yield _rows(position, nearest(parts, books[position])[0], salt, np.full(len(rows), -1), parts)

    return run


def _rows(position: int, entry: np.ndarray, salt: np.ndarray, came_from: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
    bounds = np.arange(len(parts) + 1, dtype=np.int32) * parts.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(parts), position, np.int32)), pa.array(entry.astype(np.int32)), pa.array(salt.astype(np.int64)),
            pa.array(came_from.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(parts).ravel().astype(np.int32))),
        ],
        names=["position", "entry", "salt", "came_from", "part"],
    )


_MEMBER = "position int, entry int, salt bigint, came_from int, part array<int>"


def _moving(books: list[np.ndarray], since: int, coding: Coding) -> Callable:
    """The members that came in round `since`, have stayed ever since, and now change entry.

    books: the codebooks by which rounds 1, 2, ... assigned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[2]
        for batch in batches:
            position, entry, salt = (batch.column(i).to_numpy() for i in range(3))
            parts = batch.column(4).flatten().to_numpy().reshape(-1, width).astype(np.int64)
            for p in np.unique(position).tolist():
                rows = np.flatnonzero(position == p)
                for book in books[since:-1]:
                    rows = rows[nearest(parts[rows], book[p])[0] == entry[rows]]
                now = nearest(parts[rows], books[-1][p])[0]
                moves = now != entry[rows]
                rows, now = rows[moves], now[moves]
                if len(rows):
                    yield _rows(p, now, salt[rows], entry[rows], parts[rows])

    return run


def _changes(members: DataFrame, width: int, shape: tuple[int, int]) -> np.ndarray:
    """(position, entry, sums and count) of arrivals less departures; entries * dimension numbers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*shape, width + 1), np.int64)
        for batch in batches:
            position, entry, came_from = (batch.column(i).to_numpy() for i in (0, 1, 3))
            parts = batch.column(4).flatten().to_numpy().reshape(-1, width).astype(np.int64)
            parts = np.hstack([parts, np.ones((len(parts), 1), np.int64)])
            np.add.at(total, (position, entry), parts)
            left = came_from >= 0
            np.subtract.at(total, (position[left], came_from[left]), parts[left])
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.ravel()[slot])], names=["slot", "change"])

    rows = members.mapInArrow(add, "slot bigint, change bigint").groupBy("slot").agg(F.sum("change").alias("change")).collect()
    out = np.zeros((*shape, width + 1), np.int64)
    for r in rows:
        out.ravel()[r["slot"]] = r["change"]
    return out


def first_entries(rows: DataFrame, coding: Coding) -> np.ndarray:
    """(position, entry, component) of the vectors with the smallest ids; at most `entries` rows reach the driver."""
    by_id = F.asc_nulls_last("id")
    least = rows.orderBy(by_id, "x").limit(1).collect()
    if not least:
        return np.zeros((coding.parts, 0, 0), np.int64)
    dimension = len(least[0]["x"])
    if dimension % coding.parts:
        raise ValueError(f"vectors of {dimension} components do not divide into {coding.parts} parts")
    alike = rows.where(F.size("x") == dimension)
    ids = [r["id"] for r in alike.select("id").distinct().orderBy(by_id).limit(coding.entries).collect()]
    wanted = F.col("id").isin([i for i in ids if i is not None])
    wanted = wanted | F.col("id").isNull() if None in ids else wanted
    some = alike.where(wanted).groupBy("id").agg(F.min("x").alias("x")).orderBy(by_id).collect()
    x = np.floor(coding.scale * np.array([r["x"] for r in some]))
    if np.abs(x).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT // coding.scale} or more in size does not fit")
    return np.stack(np.split(x.astype(np.int64), coding.parts, axis=1))


def train(rows: DataFrame, coding: Coding = Coding()) -> np.ndarray:
    """(position, entry, component): the codebooks after all rounds over rows of kept()."""
    books = [first_entries(rows, coding)]
    positions, entries, width = books[0].shape
    if not entries:
        return books[0]
    dimension = positions * width
    salts = -(-rows.count() // coding.members)
    owner = ("position", "entry", "salt")
    residents: list[DataFrame] = []
    total = np.zeros((positions, entries, width + 1), np.int64)
    for place in range(coding.rounds):
        if place == 0:
            moving = rows.mapInArrow(_deal(dimension, books[0], salts, coding), _MEMBER)
        else:
            moving = None
            for since, members in enumerate(residents, 1):
                some = members.mapInArrow(_moving(list(books), since, coding), _MEMBER)
                moving = some if moving is None else moving.unionAll(some)
        arrived = stored(moving.repartition(*owner), f"members-{place}")
        if place and arrived.isEmpty():
            break
        residents.append(arrived)
        total += _changes(arrived, width, (positions, entries))
        count = total[:, :, -1:]
        books.append(np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), books[-1]))
    return books[-1]


def encode(rows: DataFrame, books: np.ndarray, coding: Coding = Coding()) -> DataFrame:
    """id, label, entries (array, in part order) and error (squared distances, summed) of the rows of kept()."""
    positions, entries, width = books.shape
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, entries array<int>, error bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not entries:
            return
        for batch in batches:
            own, x = whole(batch, positions * width, coding)
            found = [nearest(part, book) for part, book in zip(np.split(x, positions, axis=1), books)]
            code = np.stack([e for e, _ in found], axis=1).astype(np.int32)
            error = np.sum([d for _, d in found], axis=0).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * positions), pa.array(code.ravel()))
            where = pa.array(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(where), batch.column(2).take(where), lists, pa.array(error)],
                names=["id", "label", "entries", "error"],
            )

    return rows.mapInArrow(run, schema)


def label_errors(codes: DataFrame) -> DataFrame:
    """The codes with label_error, the error summed over equal labels; one row per label meets the codes in a join."""
    totals = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")


def books_sha256(books: np.ndarray) -> str:
    """Digest of all whole numbers by part, entry and place within the part, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
