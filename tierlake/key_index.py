"""Which partitions may hold a key: bitmaps of hashed keys, kept beside a table.

A key has a slot, its hash (a single whole number: itself) modulo the number of slots. The index has one row per
partition and stretch of 32,768 slots in which the partition has a key, with a bitmap of the slots; rows for one
stretch may repeat, as later batches add theirs. A partition whose bitmaps share no bit with those of a batch holds
none of its keys. Shared bits may be chance, so what the index names is still to be compared by key: an index with
few slots costs reading, never correctness. Chance stays rare while slots are many times the keys of a partition
times those of a batch, or where whole-number keys of a partition lie close together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 1 << 24


def _slot(df: DataFrame, keys: Sequence[str], slots: int) -> Column:
    single = df.schema[keys[0]].dataType if len(keys) == 1 else None
    whole = isinstance(single, T.IntegralType)
    number = F.col(f"`{keys[0]}`").cast("bigint") if whole else F.xxhash64(*(F.col(f"`{k}`") for k in keys))
    return F.pmod(number, F.lit(slots)) + 1  # the bitmap functions count from one


def bitmaps(df: DataFrame, keys: Sequence[str], parts: Sequence[str] = (), slots: int = SLOTS) -> DataFrame:
    """``(*parts, stretch, bits)`` of the rows whose keys are all there; combined in map tasks."""
    slot = _slot(df, keys, slots)
    marked = df.dropna(subset=list(keys)).select(*(F.col(f"`{p}`") for p in parts), slot.alias("_slot"))
    return marked.groupBy(*(f"`{p}`" for p in parts), F.bitmap_bucket_number("_slot").alias("stretch")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("bits"))


def holders(index: DataFrame, batch: DataFrame, keys: Sequence[str], parts: Sequence[str],
            slots: int = SLOTS) -> DataFrame:
    """The distinct partitions of an index that may hold a key of a batch."""
    wanted = bitmaps(batch, keys, (), slots).withColumnRenamed("bits", "_wanted")
    # Every index row is met by at most one row of the batch; both bitmaps of the pair go through the AND.
    met = index.join(wanted, "stretch").withColumn("_pair", F.monotonically_increasing_id())
    both = met.select(*(F.col(f"`{p}`") for p in parts), "_pair", F.explode(F.array("bits", "_wanted")).alias("bits"))
    shared = both.groupBy(*(f"`{p}`" for p in parts), "_pair").agg(
        F.bitmap_count(F.bitmap_and_agg("bits")).alias("shared"))
    return shared.filter("shared > 0").select(*(F.col(f"`{p}`") for p in parts)).distinct()


def merged(index: DataFrame, parts: Sequence[str]) -> DataFrame:
    """One row per partition and stretch."""
    return index.groupBy(*(f"`{p}`" for p in parts), "stretch").agg(F.bitmap_or_agg("bits").alias("bits"))
