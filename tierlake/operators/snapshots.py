"""One row per key: newest record wins, within a batch and against the last snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOT_ORDERABLE = (T.MapType, T.VariantType)


def _newest_first(df: DataFrame, keys: Sequence[str], order_by: str | None) -> list[Column]:
    """Order by time, then by all other columns so that ties have one outcome."""
    order = [F.col(f"`{order_by}`").desc_nulls_last()] if order_by in df.columns else []
    rest = [
        field.name for field in df.schema
        if field.name not in {*keys, order_by} and not isinstance(field.dataType, _NOT_ORDERABLE)
    ]
    return order + [F.col(f"`{name}`").desc_nulls_last() for name in rest]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """Newest row of each key; without keys the distinct rows.

    Spark puts a window group limit in front of the shuffle, so every map task sends at
    most one row per key, whatever share of the rows one key has.
    """
    if not keys:
        return df.distinct()
    order = _newest_first(df, keys, order_by) or [F.lit(0)]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def merge_snapshots(previous: DataFrame, batch: DataFrame, keys: Sequence[str],
                    order_by: str | None = None, *, previous_unique: bool = False) -> DataFrame:
    """The last snapshot brought up to date with a batch.

    The larger time wins, so a late record never replaces a newer state; on equal times,
    or without a time column, the batch wins. Columns are matched by name and must agree.

    With ``previous_unique`` (the snapshot was built with the same keys) nothing of the
    snapshot is ranked: its rows and those of the batch, both one per key, meet in one full
    join. The snapshot is shuffled once, the batch once for its own ranking and the join
    together, and a key has at most two rows, so no key is hot.
    """
    if not keys:
        return batch.unionByName(previous).distinct()
    columns = batch.columns
    batch = latest_per_key(batch, keys, order_by)
    if previous_unique:
        return _newer_of_two(previous.select(*columns), batch, keys, order_by)
    ranked = batch.withColumn("_old", F.lit(0)).unionByName(previous.select(*columns).withColumn("_old", F.lit(1)))
    time, *ties = _newest_first(batch, keys, order_by) or [F.lit(0)]
    if order_by in batch.columns:
        order = [time, F.col("_old"), *ties]
    else:
        order = [F.col("_old"), time, *ties]
    newest = Window.partitionBy(*keys).orderBy(*order)
    return ranked.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").select(*columns)


def _newer_of_two(previous: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: str | None) -> DataFrame:
    """One row per key of two frames that have one row per key each."""
    columns = batch.columns
    old = previous.select(*(F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(columns)), F.lit(True).alias("_old"))
    new = batch.select(*(F.col(f"`{c}`").alias(f"_n{i}") for i, c in enumerate(columns)), F.lit(True).alias("_new"))
    same = F.lit(True)
    for key in keys:
        at = columns.index(key)
        same = same & F.col(f"_o{at}").eqNullSafe(F.col(f"_n{at}"))
    wins = F.col("_old").isNull()
    if order_by in columns:
        at = columns.index(order_by)
        before, now = F.col(f"_o{at}"), F.col(f"_n{at}")
        wins = wins | (F.col("_new") & (before.isNull() | F.coalesce(now >= before, F.lit(False))))
    else:
        wins = wins | F.col("_new").isNotNull()
    wins = F.coalesce(wins, F.lit(False))
    return old.join(new, same, "full").select(*(
        F.when(wins, F.col(f"_n{i}")).otherwise(F.col(f"_o{i}")).alias(c) for i, c in enumerate(columns)))


def snapshots_along(rows: DataFrame, days: Sequence[date], keys: Sequence[str], order_by: str | None = None,
                    day: str = "snapshot_date") -> DataFrame:
    """The snapshot of every day of ``days`` from rows that arrived on ``day``, in one pass.

    The same as ``merge_snapshots`` day after day: the larger time wins, on equal times or without a
    time column the later day. Each key has one row per day of arrival after the first step; its
    best so far holds from there until the next one, and is written out for each of the days
    between. Without keys a row stays from the first day it arrived.
    """
    columns = [c for c in rows.columns if c != day]
    if not keys:
        # Grouping treats nulls as equal, as distinct() does.
        since = rows.groupBy(*columns).agg(F.min(day).alias("_from")).withColumn("_to", F.lit(None).cast("date"))
    else:
        newest = Window.partitionBy(*keys, day).orderBy(*(_newest_first(rows, [*keys, day], order_by) or [F.lit(0)]))
        one = rows.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")
        along = Window.partitionBy(*keys).orderBy(day)
        # Nulls are the least in a struct, as a missing time is.
        rank = F.struct(*([order_by] if order_by in columns else []), day)
        best = F.max_by(F.struct(*columns), rank).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        since = one.select(best.alias("_best"), F.col(day).alias("_from"), F.lead(day).over(along).alias("_to"))
        since = since.select("_best.*", "_from", "_to")
    each = F.filter(F.array(*(F.lit(d) for d in days)),
                    lambda d: (d >= F.col("_from")) & (F.col("_to").isNull() | (d < F.col("_to"))))
    return since.withColumn(day, F.explode(each)).select(*rows.columns)
