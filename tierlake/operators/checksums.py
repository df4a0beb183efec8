"""Row-level reconciliation by order-free checksums: compare buckets, then only the rows of buckets that differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024
_HALF = 0xFFFFFFFF


def row_hashes(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of a row that are unlike each other; together 128 bits."""
    hard = [c for c in columns if isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    if hard:
        raise ValueError(f"There is no hash of {', '.join(hard)}")
    # A hash passes over nulls; which ones there are is hashed too.
    named = [F.col(f"`{c}`") for c in columns]
    gaps = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in named))
    return F.xxhash64(gaps, *named), F.xxhash64(F.lit("second"), *reversed(named), gaps)


def totals(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Count, two sums and two exclusive ors that depend on the rows and how often each stands, not on their order."""
    one, other = row_hashes(df, columns)
    return [
        F.count(F.lit(1)).alias("rows"), F.bit_xor(one).alias("xor_one"), F.bit_xor(other).alias("xor_other"),
        # Sums of halves cannot overflow.
        F.sum(one.bitwiseAND(F.lit(_HALF))).alias("sum_one"), F.sum(F.shiftrightunsigned(other, 32)).alias("sum_other"),
    ]


def checksums(df: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket of keys, combined in map tasks."""
    bucket = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(buckets)).alias("bucket")
    return df.groupBy(bucket).agg(*totals(df, sorted(df.columns)))


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``(*keys, status, missing, extra)`` of the keys whose rows are not the same on both sides.

    ``lost``: fewer rows on the right; ``doubled``: rows of the left more often; ``added``: other rows as well;
    ``changed``: some went and others came. Both sides are scanned once for their checksums, a few numbers per
    bucket, and a second time only in the buckets that differ. Neither side is sorted, joined or collected.
    """
    if not keys:
        raise ValueError("Rows are told apart by key columns")
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError("Column names and types of both sides must match")
    sums = [checksums(df, keys, buckets) for df in (left, right)]
    names = [c for c in sums[0].columns if c != "bucket"]
    other = sums[1].withColumnsRenamed({c: f"_{c}" for c in sums[1].columns})
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    met = sums[0].join(other, F.col("bucket") == F.col("_bucket"), "full").filter(~same)
    # At most as many numbers as there are buckets.
    wrong = [row[0] for row in met.select(F.coalesce("bucket", "_bucket")).collect()]
    columns = sorted(left.columns)

    def rows(df: DataFrame, side: int) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(buckets))
        one, two = row_hashes(df, columns)
        named = [F.col(f"`{k}`").alias(k) for k in keys]
        return df.filter(bucket.isin(*wrong)).select(*named, one.alias("_one"), two.alias("_two"), F.lit(side).alias("_side"))

    both = rows(left, 0).unionByName(rows(right, 1)).groupBy(*(f"`{k}`" for k in keys), "_one", "_two").agg(
        F.count_if(F.col("_side") == 0).alias("_left"), F.count_if(F.col("_side") == 1).alias("_right"))
    lost, more = F.greatest(F.col("_left") - F.col("_right"), F.lit(0)), F.greatest(F.col("_right") - F.col("_left"), F.lit(0))
    found = both.filter("_left <> _right").groupBy(*(f"`{k}`" for k in keys)).agg(
        F.sum(lost).alias("missing"), F.sum(more).alias("extra"),
        F.sum(F.when(F.col("_left") == 0, more).otherwise(0)).alias("_new"))
    status = (
        F.when(F.col("extra") == 0, "lost").when(F.col("missing") > 0, "changed")
        .when(F.col("_new") == 0, "doubled").otherwise("added"))
    return found.select(*(F.col(f"`{k}`") for k in keys), status.alias("status"), "missing", "extra")
