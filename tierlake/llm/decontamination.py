"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A document leaks an item if some WINDOW aligned words of the two differ in at most SUBSTITUTIONS places. An item of
fewer words is one window, and its tolerance shrinks with it: one place from seven words on, none below. Words are
lower-cased runs without ASCII white space. Each mask hashes a few of the words in a span and ignores the others; at
every choice of substitutions in a window, at least one of its masks fits beside them somewhere, so no leak is missed:
SEEDS for full windows, half the item's words for one substitution, the whole item for none. Only masks that some item
needs are laid over the documents. Hits give the document, item and offset between the two, which are then verified
word by word.

The document side is not shuffled to find hits: the item side is broadcast in blocks of at most BLOCK seeds (28
bytes each), and a benchmark of more seeds takes one pass over the documents for each block. A passage in a third
of all documents gives one hit row per document and offset, and partial aggregation removes repeats in map tasks.
Hits of one document go to verification in lists of about LIST; a document with more has several.

Defined cases: null and empty texts leak nothing; items without words are never found; an item of one word leaks
wherever that word stands; repeated documents and items each get their rows; among alignments of one pair the one with
the most equal words, then the first, is reported; empty tables give an empty result; other columns are ignored by
leaks() and kept by clean().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import stored

WINDOW = 13
SUBSTITUTIONS = 2
SEEDS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 7, 8))
BLOCK = 1_000_000
LIST = 10_000


def tolerance(n: int) -> int:
    """Substitutions in a window of so many words."""
    return SUBSTITUTIONS * n // WINDOW


def masks(n: int) -> tuple[tuple[int, ...], ...]:
    """The masks of an item of so many words; WINDOW stands for all longer ones."""
    if n >= WINDOW:
        return SEEDS
    return (tuple(range(n // (tolerance(n) + 1))),)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def seeds(hashes: Column, used: list[tuple[int, ...]]) -> Column:
    """(position, hash) of every fit of every mask over an array of word hashes."""

    def fits(mask: tuple[int, ...]) -> Column:
        last = F.size(hashes) - mask[-1]
        return F.when(
            last > 0,
            F.transform(
                F.sequence(F.lit(1), last),
                lambda i: F.struct(
                    i.alias("at"),
                    F.xxhash64(F.lit(str(mask)), *(F.element_at(hashes, (i + p).cast("int")) for p in mask)).alias("seed"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<at:int,seed:bigint>>"))

    return F.concat(*map(fits, used))


def _seeded(df: DataFrame, text: str, used: list[tuple[int, ...]], *keys: Column) -> DataFrame:
    hashes = F.transform(words(F.col(text)), lambda w: F.xxhash64(w))
    return (
        df.select(*keys, hashes.alias("hashes"))
        .select("*", F.explode(seeds(F.col("hashes"), used)).alias("s")).select("*", "s.at", "s.seed").drop("hashes", "s")
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per leaking document and item: doc_id, item_id, start (word, from 0), n_equal, n_item."""
    mark = F.xxhash64("text")
    items = benchmark.select("item_id", "text", F.xxhash64("item_id", "text").alias("item"))
    n_words = F.least(F.size(words(F.col("text"))), F.lit(WINDOW))
    # At most WINDOW lengths.
    lengths = sorted(r[0] for r in items.select(n_words.alias("n")).distinct().collect() if r[0])
    if not lengths:
        lengths = [WINDOW]
    small = None
    for n in lengths:
        own = _seeded(items.where(n_words == n), "text", list(masks(n)), F.col("item"))
        small = own if small is None else small.unionAll(own)
    small = stored(small.distinct(), "seeds")
    n_blocks = -(-max(1, small.count()) // BLOCK)
    used = sorted({mask for n in lengths for mask in masks(n)})
    rows = _seeded(docs, "text", used, F.col("doc_id"), mark.alias("mark"))
    hits = None
    for block in range(n_blocks):
        part = small.where(F.pmod(F.xxhash64("seed"), F.lit(n_blocks)) == block) if n_blocks > 1 else small
        part = part.select("item", F.col("at").alias("item_at"), F.col("seed").alias("item_seed"))
        # Bounded by BLOCK rows (about: blocks are dealt by hash).
        found = rows.join(F.broadcast(part), F.col("seed") == F.col("item_seed"))
        found = found.select("doc_id", "mark", "item", (F.col("at") - F.col("item_at")).alias("shift"))
        hits = found if hits is None else hits.unionAll(found)
    lists = F.ceil(F.count("*").over(Window.partitionBy("doc_id", "mark")) / LIST)
    hits = hits.distinct().withColumn("list", F.pmod(F.xxhash64("item", "shift"), lists))
    hits = hits.groupBy("doc_id", "mark", "list").agg(F.collect_list(F.struct("item", "shift")).alias("hits")).drop("list")

    own = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("own_mark"), "text")
    met = own.join(hits, F.col("doc").eqNullSafe(F.col("doc_id")) & (F.col("own_mark") == F.col("mark")))
    # From here on a row has only the words that stand opposite to an item's.
    texts = items.select(F.col("item").alias("item_key"), "item_id", words(F.col("text")).alias("item_words"))
    aligned = (
        met.select("doc_id", words(F.col("text")).alias("words"), F.col("hits"))
        .select("doc_id", "words", F.explode("hits").alias("h"))
        .join(texts, F.col("h.item") == F.col("item_key"))
        .select(
            "doc_id", "item_id", F.col("h.shift").alias("shift"), F.size("item_words").alias("n_item"),
            F.transform(
                "item_words",
                lambda w, j: F.coalesce(F.get("words", (j + F.col("h.shift")).cast("int")) == w, F.lit(False)).cast("int"),
            ).alias("equal"),
        )
    )
    span = F.least(F.col("n_item"), F.lit(WINDOW))
    need = span - F.floor(SUBSTITUTIONS * span / WINDOW)
    total = F.aggregate("equal", F.lit(0), lambda a, x: a + x)
    best = F.exists(
        F.sequence(F.lit(1), F.col("n_item") - span + 1),
        lambda i: F.aggregate(F.slice("equal", i, span), F.lit(0), lambda a, x: a + x) >= need,
    )
    verified = aligned.withColumn("n_equal", total).where((F.col("n_equal") >= need) & best)
    top = F.max(F.struct("n_equal", (-F.col("shift")).alias("back"), "n_item")).alias("top")
    return (
        verified.groupBy("doc_id", "item_id").agg(top)
        .select("doc_id", "item_id", (-F.col("top.back")).alias("start"), "top.n_equal", "top.n_item")
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that leak no item; rows whose id is null are judged by their text alone."""
    found = leaks(docs.select(F.struct("doc_id", F.xxhash64("text").alias("mark")).alias("doc_id"), "text"), benchmark)
    bad = found.select(F.col("doc_id.doc_id").alias("_bad"), F.col("doc_id.mark").alias("_mark")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("text").alias("own"))
    on = F.col("row.doc_id").eqNullSafe(F.col("_bad")) & (F.col("own") == F.col("_mark"))
    return rows.join(bad, on, "left_anti").select("row.*")
