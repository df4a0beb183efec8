"""N-gram Jaccard join with signature trees: links, components and near-duplicate removal over word shingles.

Two texts link when 100 * intersection >= percent * union of their sets of word shingles (lower-cased A-Z words
without ASCII white space). The join is exact:

1. Sets: one pass gives each text's set size, a 128-bit signature of the set, its prefix and its bitmap. The
   prefix are the floor((100 - percent) n / 100) + 1 first shingles in an order common to all texts, frequent ones
   last as far as a fixed-size count sketch over all texts shows them; two linked sets share a prefix shingle.
   Texts with equal sets become one class, so copies never meet again.
2. Candidates: prefix shingles are range-partitioned with sizes; a row stays if a neighbour has its shingle and a
   size that allows a link. Shingles with the same texts count as one. The rows of a shingle, with bitmaps, are joined by dual traversal of signature trees;
   pairs that the bitmaps allow are united, and pairs already united are skipped, so a group gives at most one edge
   per row. Components of these edges hold every link inside them.
3. Links: the sets of each component's classes meet in a task, again by dual traversal; what the bitmaps allow is
   counted exactly. Links are counted per class and reduced to a spanning forest; components of the forest are
   the answer.

A group of more than LIMIT shingles is split by hash into blocks, and each pair of blocks is a task of its own, so
no task holds more than two blocks.

Defined cases: a null or empty text, or one without words, has an empty set and links with nothing; fewer words
than a shingle count as one shingle; a row without id links with nothing and has no component; rows with equal
ids are told apart by their text, and equal rows are copies; an empty table gives an empty result; other columns
are ignored by join() and kept by keep_one().
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .repeats import collect, mark
from .signature_tree import bitmaps, similar
from .text import LOWER, U64, Words, chunks, inside, mix, span_hash, sums, windows
from .work import stored

#: Counters of the sketch that puts frequent shingles last.
SKETCH = 20
SKETCH_BLOCKS = 32
#: Shingles in a block of a group.
LIMIT = 4_000_000
#: Bits of the filter that keeps texts without candidates out of a shuffle.
FILTER = 24


@dataclass(frozen=True)
class Similarity:
    shingle: int = 5
    percent: int = 80


def sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, token, size per row): the distinct shingles of each text, ordered by row and token."""
    words = Words(LOWER[data], offsets)
    prefix = sums(words.hashes())
    fits = np.flatnonzero(inside(words.row, shingle))
    row, token = words.row[fits], windows(prefix, shingle)[fits]
    short = np.flatnonzero((words.count > 0) & (words.count < shingle))
    if len(short):
        row = np.concatenate([row, short])
        token = np.concatenate([token, span_hash(prefix, words.bounds[short], words.bounds[short + 1])])
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (token[1:] != token[:-1])
    row, token = row[new], token[new]
    return row, token, np.bincount(row, minlength=len(offsets) - 1).astype(np.int64)


def _sum(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=total[1:])
    return (total[cut[1:]] - total[cut[:-1]]).view(np.int64)


def signatures(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set."""
    cut = np.concatenate([[0], np.cumsum(n)])
    return _sum(mix(token + U64(1)), cut), _sum(mix(token ^ U64(0x5851F42D4C957F2D)), cut)


def rarity(docs: DataFrame, like: Similarity) -> np.ndarray:
    """Levels by sketch counter: 0 for most shingles, higher the more texts have them. Fixed size, counts all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2**SKETCH, np.int32)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                _, token, _ = sets(data, offsets, like.shingle)
                total += np.bincount((token & U64(2**SKETCH - 1)).astype(np.int64), minlength=2**SKETCH).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SKETCH_BLOCKS)), pa.array([x.tobytes() for x in np.split(total, SKETCH_BLOCKS)], pa.binary())],
            names=["block", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[block] = held.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["block", "counts"]
            )

    parts = docs.select("text").mapInArrow(count, "block bigint, counts binary")
    rows = parts.repartition(SKETCH_BLOCKS, "block").mapInArrow(add, "block bigint, counts binary").collect()
    total = np.zeros((SKETCH_BLOCKS, 2**SKETCH // SKETCH_BLOCKS), np.int64)
    for r in rows:
        total[r["block"]] = np.frombuffer(r["counts"], np.int64)
    total = total.ravel()
    # Most of a counter are shingles of one text each; what stands out by chance is about its square root.
    usual = np.median(total)
    step = 3 * np.sqrt(usual) + 4
    over = (total - usual) / step
    return np.where(over > 1, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)


def _documents(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL").select("text", "doc_id", mark())


def features(docs: DataFrame, like: Similarity, levels: np.ndarray | None) -> DataFrame:
    """doc_id, mark, n, sign and check (the set's signature); with levels also the prefix and the bitmap."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(0)):
                row, token, n = sets(data, offsets, like.shingle)
                sign, check = signatures(row, token, n)
                columns = [batch.column(i).slice(at, to - at) for i in (1, 2)] + [pa.array(x) for x in (n, sign, check)]
                if levels is not None:
                    order = np.lexsort((token, levels[(token & U64(2**SKETCH - 1)).astype(np.int64)], row))
                    cut = np.concatenate([[0], np.cumsum(n)])
                    place = np.arange(len(row)) - cut[row]
                    size = np.where(n > 0, n - -(-like.percent * n // 100) + 1, 0)
                    first = token[order][place < size[row]].view(np.int64)
                    bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    columns += [pa.ListArray.from_arrays(pa.array(bounds), pa.array(first)), pa.array(bitmaps(row, token, n), pa.binary())]
                names = ["doc_id", "mark", "n", "sign", "check", "prefix", "bits"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, mark bigint, n bigint, sign bigint, check bigint"
    return _documents(docs).mapInArrow(work, schema + (", prefix array<bigint>, bits binary" if levels is not None else ""))


def _near(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a bucket sorted by token and size with a neighbour they may link to; its ends always stay.

        A group that lies whole in the bucket gets a hash of its members for a token: most tokens that two texts
        share have the same members, and a set of members needs to be looked at once.
        """
        table = collect(batches)
        if table is None:
            return
        token, n = table["token"].to_numpy(), table["n"].to_numpy()
        near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
        stay = np.append(near, True)
        stay[1:] |= near
        stay[0] = True
        token, n, node = token[stay], n[stay], table["node"].to_numpy()[stay]
        head = np.append(True, token[1:] != token[:-1])
        group = np.cumsum(head) - 1
        members = np.add.reduceat(mix(node.view(U64)), np.flatnonzero(head))
        whole = (group > 0) & (group < group[-1])
        token = np.where(whole, mix(members).view(np.int64)[group], token)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, n, node)], names=["token", "n", "node"])

    return run


def _dealt(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The rows with lo, hi and block: groups of more than `limit` shingles as pairs of blocks."""
    weight = rows.groupBy(key).agg(F.sum("n").alias("weight")).where(F.col("weight") > limit)
    large = weight.select(F.col(key).alias("_key"), F.ceil(F.col("weight") / limit).cast("int").alias("blocks"))
    rows = rows.join(large, F.col(key) == F.col("_key"), "left").drop("_key")
    blocks = F.coalesce("blocks", F.lit(1))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    return rows.drop("blocks", "other")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted rows; the first so many columns tell groups apart."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(i).to_numpy() for i in range(keys)]
        change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1
        fresh = held and any(held[-1].column(i)[-1].as_py() != batch.column(i)[0].as_py() for i in range(keys))
        if fresh:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if len(change):
            last = int(change[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks()
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def unite(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _candidates(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per group: edges that unite the classes whose bitmaps allow a link."""
        for table in _groups(batches, 3):
            token, lo, hi, block, node, n = (table.column(i).to_numpy() for i in range(6))
            bits = table.column(6).to_pylist()
            cut = np.flatnonzero((token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            edges: list[tuple[int, int]] = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(token)]):
                if b - a < 2:
                    continue
                forest = Forest(b - a)

                def united(x: np.ndarray, y: np.ndarray) -> bool:
                    root = forest.root(int(x[0]))
                    return all(forest.root(i) == root for i in x.tolist()) and all(forest.root(i) == root for i in y.tolist())

                side = block[a:b] if lo[a] != hi[a] else None
                for i, j in similar(n[a:b], bits[a:b], percent, side, united if b - a > 64 else None):
                    edges += [(a + x, a + y) for x, y in zip(i.tolist(), j.tolist()) if forest.unite(x, y)]
            if edges:
                one, other = (node[list(x)] for x in zip(*edges))
                yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(other)], names=["a", "b"])

    return run


def _links(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per component: a spanning forest of its links (a, b) and the number of linked texts of each class (a, links)."""
        for table in _groups(batches, 3):
            label, lo, hi, block, node, n, copies = (table.column(i).to_numpy() for i in range(7))
            cut = np.flatnonzero((label[1:] != label[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
            out: list[tuple[int, int | None, int]] = []
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(label)]):
                if b - a < 2:
                    continue
                tokens = [np.frombuffer(x.as_py(), U64) for x in table.column(7).slice(a, b - a)]
                size, times = n[a:b], copies[a:b]
                bits = bitmaps(np.repeat(np.arange(b - a), size), np.concatenate(tokens), size)
                forest, links = Forest(b - a), np.zeros(b - a, np.int64)
                side = block[a:b] if lo[a] != hi[a] else None
                for i, j in similar(size, bits, percent, side):
                    for x in np.unique(i).tolist():
                        other = j[i == x]
                        many = np.concatenate([tokens[y] for y in other.tolist()])
                        own = tokens[x]
                        hit = own[np.minimum(np.searchsorted(own, many), len(own) - 1)] == many
                        shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(size[other]) - size[other])
                        for y in other[shared * (100 + percent) >= percent * (size[x] + size[other])].tolist():
                            links[x] += times[y]
                            links[y] += times[x]
                            if forest.unite(x, y):
                                out.append((int(node[a + x]), int(node[a + y]), 0))
                out += [(int(node[a + x]), None, int(links[x])) for x in np.flatnonzero(links).tolist()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["a", "b", "links"])

    return run


def bit_filter(df: DataFrame, column: str) -> np.ndarray:
    """A bitmap of fixed size (2 MB) that has a bit for each value; made by a grouped OR, at most 2**18 rows."""
    slot = F.pmod(F.col(column), F.lit(2**FILTER))
    words = df.select(F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    out = np.zeros(2**FILTER // 64, np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def maybe(df: DataFrame, known: np.ndarray, want: bool = True) -> DataFrame:
    """The rows whose column mark may be, or surely is not, among the values of a filter."""
    packed = np.packbits(known)
    at = df.columns.index("mark")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(packed).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(table[batch.column(at).to_numpy() & (2**FILTER - 1)] == want))

    return df.mapInArrow(run, df.schema)


def _token_blobs(shingle: int, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(0)):
                _, token, n = sets(data, offsets, shingle)
                cut = np.concatenate([[0], np.cumsum(n)]).tolist()
                blobs = [token[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                rest = [batch.column(i).slice(at, to - at) for i in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(blobs, pa.binary())], names=["label", "node", "n", "copies", "tokens"])

    return run


def linked_classes(docs: DataFrame, like: Similarity, limit: int = LIMIT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, labels, links): signature, node, copies and smallest doc_id of each set; component label and links per node.

    A node is a number of its own for each class, given when the classes are written.
    """
    levels = rarity(docs, like)
    found = features(docs, like, levels).where("n > 0")
    first = [F.first(c).alias(c) for c in ("doc_id", "mark", "prefix", "bits")]
    classes = found.groupBy("n", "sign", "check").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), *first)
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    tokens = classes.select(F.explode("prefix").alias("token"), "n", "node")
    order = ("token", "n", "node")
    near = tokens.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_near(like.percent), "token bigint, n bigint, node bigint")
    near = stored(near.distinct(), "near")
    with_bits = _dealt(near, "token", limit).join(classes.select("node", "bits"), "node")
    group = ("token", "lo", "hi")
    edges = (
        with_bits.select(*group, "block", "node", "n", "bits").repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_candidates(like.percent), "a bigint, b bigint")
    )
    around = components(edges)

    members = stored(around.join(classes.drop("sign", "check", "prefix", "bits", "least"), "node"), "members")
    known = bit_filter(members, "mark")
    there = members.select(
        "label", "node", F.col("n").alias("n"), "copies", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")
    )
    texts = maybe(_documents(docs), known).join(there, (F.col("doc_id") == F.col("_id")) & (F.col("mark") == F.col("_mark")))
    blobs = (
        texts.dropDuplicates(["node"]).select("text", "label", "node", "n", "copies")
        .mapInArrow(_token_blobs(like.shingle, ""), "label bigint, node bigint, n bigint, copies bigint, tokens binary")
    )
    blobs = stored(blobs, "sets")
    group = ("label", "lo", "hi")
    found = (
        _dealt(blobs, "label", limit).select(*group, "block", "node", "n", "copies", "tokens")
        .repartition(*group).sortWithinPartitions(*group).mapInArrow(_links(like.percent), "a bigint, b bigint, links bigint")
    )
    found = stored(found, "links")
    labels = components(found.where("b IS NOT NULL").select("a", "b"))
    links = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    return classes.select("n", "sign", "check", "node", "copies", "least"), labels, links


def join(docs: DataFrame, like: Similarity = Similarity(), limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable), n_links, mark."""
    classes, labels, links = linked_classes(docs, like, limit)
    known = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = known.groupBy("label").agg(F.min("least").alias("component"))
    known = known.join(least, "label").join(links, "node", "left").select(
        "n", "sign", "check", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    out = features(docs, like, None).join(known, ["n", "sign", "check"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"), "mark",
    )
    kind = docs.schema["doc_id"].dataType
    lost = docs.where("doc_id IS NULL")
    nobody = (
        lost.select("text", F.monotonically_increasing_id().alias("doc_id"))
    )
    lone = features(nobody, like, None).select(
        F.lit(None).cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast(kind).alias("component_id"),
        F.lit(0).cast("bigint").alias("n_links"), "mark",
    )
    return out.unionAll(lone)


def keep_one(docs: DataFrame, like: Similarity = Similarity(), limit: int = LIMIT) -> DataFrame:
    """The rows, with all their columns, less the documents of a component that are not its smallest id.

    Of rows with the smallest id one stays. Rows without words or without an id stay.
    """
    rows = stored(join(docs, like, limit).where("doc_id IS NOT NULL AND n_shingles > 0"), "verdicts")
    place = rows.groupBy("doc_id", "mark", "component_id").agg(F.count("*").alias("times"))
    winner = place.groupBy("component_id").agg(F.min(F.struct("doc_id", "mark")).alias("winner"))
    place = place.join(winner, "component_id").withColumn("wins", F.struct("doc_id", "mark") == F.col("winner"))
    odd = stored(
        place.where("NOT wins OR times > 1").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "wins"), "dropped"
    )
    known = bit_filter(odd, "_mark")
    named = docs.select(mark(), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rest = maybe(named, known, want=False).select("row.*")
    touched = maybe(named, known).join(
        odd, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left"
    )
    plain = touched.where("wins IS NULL").select("row.*")
    once = touched.where("wins").dropDuplicates(["_id", "_mark"]).select("row.*")
    return rest.unionAll(plain).unionAll(once)
