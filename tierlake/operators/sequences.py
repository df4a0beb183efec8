"""Numbering and look-ahead along a key, safe for a key that holds most of the rows.

A plain window puts all rows of a key into one task. Here a key is cut along the sort
order into buckets (days, hours, ...), and the window runs inside a bucket. What a bucket
has to know of the others comes from an aggregate with one row per bucket, which enters
the window as one extra row of that bucket. The rows themselves are shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numbered(df: DataFrame, keys: Sequence[str], buckets: Sequence[Column],
             order: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` per key as column ``name``.

    ``buckets`` must be non-decreasing along ``order``: rows of an earlier bucket come
    before rows of a later one.
    """
    cut = [f"_b{i}" for i in range(len(buckets))]
    group = [*keys, *cut]
    rows = df.withColumns(dict(zip(cut, buckets)))
    earlier = (
        Window.partitionBy(*keys).orderBy(*cut)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # The extra row of a bucket comes first and weighs as much as all buckets before it.
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        *group, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_weight"),
        F.lit(0).alias("_row"))
    weighed = rows.withColumns({"_weight": F.lit(1).cast("bigint"), "_row": F.lit(1)})
    along = Window.partitionBy(*group).orderBy("_row", *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        weighed.unionByName(offsets, allowMissingColumns=True)
        .withColumn(name, F.sum("_weight").over(along))
        .filter("_row = 1").select(*df.columns, name)
    )


def _next_date(dates: DataFrame, key: str, date: str, name: str) -> DataFrame:
    """For distinct ``(key, date)`` rows the following date of the key."""
    if isinstance(dates.schema[date].dataType, T.DateType):
        # A key has at most as many rows here as there are calendar days.
        return dates.withColumn(name, F.lead(date).over(Window.partitionBy(key).orderBy(date)))
    rows = dates.withColumn("_minute", F.date_trunc("minute", date))
    firsts = rows.groupBy(key, "_minute").agg(F.min(date).alias("_first"))
    # The extra row of a minute comes last and has the first time of the key's next minute.
    later = firsts.select(
        key, "_minute", F.lit(1).alias("_extra"),
        F.lead("_first").over(Window.partitionBy(key).orderBy("_minute")).alias(date))
    along = Window.partitionBy(key, "_minute").orderBy("_extra", date)
    return (
        rows.withColumn("_extra", F.lit(0)).unionByName(later, allowMissingColumns=True)
        .withColumn(name, F.lead(date).over(along))
        .filter("_extra = 0").drop("_extra", "_minute")
    )


def day_gap(df: DataFrame, key: str, date: str, order_by: Sequence[str], name: str = "d_diff") -> DataFrame:
    """Whole days from each row's ``date`` to that of the next row of the same key.

    Rows of a key follow each other by ``date`` and then by ``order_by``, which must tell
    rows of one date apart. A day is 24 hours. The last row of a key has no gap (null), nor
    has a row without a date.

    Only the last row of a date has a gap other than 0, so the look-ahead runs over the
    distinct dates of a key, however many rows they stand for. The join back is one that
    AQE can split.
    """
    # A single column keeps the aggregate a hash aggregate.
    place = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*(F.col(c) for c in order_by))
    dates = df.filter(F.col(date).isNotNull()).groupBy(key, date).agg(F.max(place).alias("_last"))
    known = _next_date(dates, key, date, "_next").select(
        F.col(key).alias("_k"), F.col(date).alias("_d"), "_last", "_next")
    gap = F.timestamp_diff("DAY", F.col(date).cast("timestamp"), F.col("_next").cast("timestamp"))
    return (
        df.join(known, F.col(key).eqNullSafe(F.col("_k")) & (F.col(date) == F.col("_d")), "left")
        .withColumn(name, F.when(place.eqNullSafe(F.col("_last")), gap)
                    .when(F.col(date).isNotNull(), F.lit(0)))
        .select(*df.columns, name)
    )
