"""The newest row per key of a stream, kept as keyed streaming state.

The state of a key, its newest row, is in the stream's state store: an aggregation in update mode takes in a
micro-batch and gives the keys that it met. Only those rows leave the batch, into a partition of their own of a change
table, so a batch writes what it changed, however large the whole state is. The published Silver table is the
changes' newest row per key; ``publish_state`` brings it up to date from time to time and drops the changes it holds.
``read_state`` gives the state as of the last batch without waiting for that.

A change is a key's whole newest row and never older than a published one, so batches that run again, changes that
were published before, and a publication that was lost on its way all give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierlake import tables
from tierlake.names import Layers, TableName
from tierlake.operators.snapshots import latest_per_key
from tierlake.streaming.ingest import checkpoint_id

_BATCH = "stream_batch"


def newest_rows(stream: DataFrame, keys: Sequence[str], order_by: str | None = None) -> DataFrame:
    """A streaming aggregation: each key with its newest row, ties by all other columns, largest first."""
    first = [order_by] if order_by in stream.columns else []
    rest = [c for c in stream.columns if c not in (*keys, *first)]
    hard = [f.name for f in stream.schema if f.name in rest and isinstance(f.dataType, (T.MapType, T.VariantType))]
    if hard:
        raise ValueError(f"The state of a key cannot be put in order by {', '.join(hard)}")
    if not first and not rest:
        return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    # Nulls are the least in a struct: a row with a time goes before one without.
    best = F.max(F.struct(*(F.col(f"`{c}`") for c in [*first, *rest]))).alias("_best")
    return stream.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*stream.columns)


def _changes(layers: Layers, name: str) -> TableName:
    return layers.resolve(f"{name}_changes", "silver")


def keep_state(stream: DataFrame, layers: Layers, name: str, keys: Sequence[str], checkpoint: str,
               order_by: str | None = None, *, interval: str | None = None) -> StreamingQuery:
    """Start the stream that keeps the state of ``name``; with no ``interval`` it handles what is there and ends.

    State that outgrows the memory of executors belongs in the RocksDB state store, a setting of the session.
    """
    table = _changes(layers, name)

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        layers.ensure(spark, "silver")
        rows = batch.withColumn(_BATCH, F.lit(f"{checkpoint_id(spark, checkpoint)}-{epoch}"))
        if tables.exists(spark, table):
            tables.overwrite_partitions(spark, table, rows)
        else:
            tables.replace(spark, table, rows, [_BATCH], allow_empty=True)

    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        newest_rows(stream, keys, order_by).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read_state(spark: SparkSession, layers: Layers, name: str, keys: Sequence[str],
               order_by: str | None = None) -> DataFrame:
    """The newest row per key, as of the last micro-batch."""
    found = []
    for table in (layers.resolve(name, "silver"), _changes(layers, name)):
        if tables.exists(spark, table):
            rows = tables.read(spark, table)
            found.append(rows.drop(_BATCH) if _BATCH in rows.columns else rows)
    if not found:
        raise ValueError(f"There is no state {name}")
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return latest_per_key(rows, keys, order_by)


def publish_state(spark: SparkSession, layers: Layers, name: str, keys: Sequence[str],
                  order_by: str | None = None) -> int:
    """Bring the Silver table up to date as a new version, and drop the changes that went in. Returns its rows.

    May run beside the stream: only batches that were there when it began are dropped.
    """
    table, changes = layers.resolve(name, "silver"), _changes(layers, name)
    # One row per micro-batch since the last publication.
    done = [row[0] for row in tables.read(spark, changes).select(_BATCH).distinct().collect()]
    rows = tables.read(spark, changes).filter(F.col(_BATCH).isin(*done)).drop(_BATCH)
    if tables.exists(spark, table):
        rows = tables.read(spark, table).unionByName(rows)
    count = tables.replace(spark, table, latest_per_key(rows, keys, order_by), allow_empty=True)
    for batch in done:
        tables.drop_partition(spark, changes, {_BATCH: batch})
    return count
