"""Incremental ingest of landed files, replay dedup and late data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierlake import tables
from tierlake.contract import Contract
from tierlake.functions.privacy import Keys
from tierlake.names import Layers, TableName, job_name, run_day
from tierlake.operators.snapshots import latest_per_key, merge_snapshots
from tierlake.plans.lake import prepare

# The physical partitions of a streamed Lake table; the batch is not among its columns.
STREAM_PARTITIONS = ("ingest_date", "stream_batch")
HIDDEN = ("stream_batch",)
# What readers see until a compaction is published.
BATCHES = "NOT coalesce(stream_batch LIKE 'compact-%', false)"


def read_landed(spark: SparkSession, path: str, *, max_files: int | None = None) -> DataFrame:
    """A stream of landed lines, as text; what they hold is checked by ``tag_lines``."""
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def tag_lines(lines: DataFrame, contract: Contract) -> DataFrame:
    """Lines as ``_line``, the contract's columns as text, and ``_reason`` where there is a fault.

    A line that is no JSON object is ``unparsable``; one with fields outside the contract
    names them. A contract field that a line lacks is null. Other columns of ``lines`` follow.
    """
    names = F.json_object_keys("value")
    extra = F.array_except(names, F.array(*(F.lit(name) for name in contract.names)))
    reason = F.when(names.isNull(), "unparsable").when(
        F.size(extra) > 0, F.concat(F.lit("undeclared: "), F.concat_ws(", ", extra)))
    fields = F.from_json("value", contract.text_schema())
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(F.col("value").alias("_line"), reason.alias("_reason"), fields.alias("_fields"), *rest).select(
        "_line", "_reason", "_fields.*", *rest)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave a checkpoint when it was made: one made anew at a path has another."""
    found = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
    return found.replace("-", "")[:16]


def publish_batch(spark: SparkSession, name: TableName, rows: DataFrame, *, one_day: bool = False) -> None:
    """Write the partitions of a micro-batch; one that runs again overwrites its own partitions only.

    ``one_day``: all rows go to one partition, so the write needs no shuffle.
    """
    if tables.exists(spark, name):
        tables.overwrite_partitions(spark, name, rows, rebalance=not one_day)
    else:
        tables.replace(spark, name, rows, STREAM_PARTITIONS, hidden=HIDDEN, allow_empty=True, rebalance=not one_day,
                       condition=BATCHES)


def _append_batch(layers: Layers, app: str, contract: Contract, keys: Keys,
                  ingest_date: str | None, checkpoint: str, strict: bool) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that takes landed lines to the Lake, faulty ones to the table of rejects."""
    table = layers.resolve(job_name(app), "lake")
    refused = layers.resolve(job_name(f"{app}_rejected"), "lake")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        mark = F.lit(f"{checkpoint_id(spark, checkpoint)}-{epoch}")
        tagged, fault, seen = tag_lines(batch, contract), F.col("_reason"), Observation()
        # Whether there are faults is seen by the write of the good rows; the lines are read again only if so.
        noted = tagged.observe(seen, F.count_if(fault.isNotNull()).alias("faults"))
        if strict:
            good = F.when(fault.isNull(), True).otherwise(F.raise_error(
                F.concat(F.lit("A landed line is refused: "), fault)).cast("boolean"))
        else:
            good = fault.isNull()
        rows = prepare(noted.filter(good).select(*contract.names), contract, keys)
        day = F.to_date(contract.order_by) if ingest_date is None else F.lit(run_day(ingest_date))
        publish_batch(spark, table, rows.withColumns({"ingest_date": day, "stream_batch": mark}),
                      one_day=ingest_date is not None)
        bad = tagged.filter(fault.isNotNull()).select(F.col("_line").alias("value"), fault.alias("reason"))
        if not strict and seen.get["faults"]:
            today = F.current_date() if ingest_date is None else F.lit(run_day(ingest_date))
            publish_batch(spark, refused, bad.withColumns({"ingest_date": today, "stream_batch": mark}))

    return write


def ingest_stream(spark: SparkSession, path: str, layers: Layers, app: str, contract: Contract, checkpoint: str,
                  *, ingest_date: str | None = None, keys: Keys = Keys(), interval: str | None = None,
                  max_files: int | None = None, strict: bool = False) -> StreamingQuery:
    """Append landed files to the Lake, each file once per checkpoint.

    Every micro-batch has a partition of its own, named after the checkpoint's id and the
    batch number, so a batch that is repeated after a failure replaces itself. The table
    does not show it: a streamed table reads like one written in batches, and batches may be
    appended to it. Without ``ingest_date`` a row's date is that of its contract timestamp.

    Lines that are no JSON object or have fields outside the contract go to the Lake table
    ``<app>_rejected`` with their reason; with ``strict`` they fail the query.
    """
    layers.ensure(spark, "lake")
    if ingest_date is None and contract.order_by is None:
        raise ValueError("Give an ingest_date, or a contract with a timestamp column")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        read_landed(spark, path, max_files=max_files).writeStream
        .foreachBatch(_append_batch(layers, app, contract, keys, ingest_date, checkpoint, strict))
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def dedup_stream(df: DataFrame, key: str, time: str | None = None, delay: str | None = None) -> DataFrame:
    """Drop repeated events of a stream.

    Exact, with one state entry per key for ever; or with ``time`` and ``delay`` within
    that time only, and state that is cleared behind the watermark.
    """
    if delay is None:
        return df.dropDuplicates([key])
    if time is None:
        raise ValueError("A delay needs a time column")
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


_BUCKETS = "tierlake.buckets"


def _bucket(keys: Sequence[str], number: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(number)).cast("int").alias("key_bucket")


def resize_buckets(spark: SparkSession, layers: Layers, name: str, keys: Sequence[str], buckets: int) -> int:
    """Deal the rows of an upserted table into another number of buckets, as a new version.

    A bucket is what a micro-batch rewrites at least, so a state that has grown wants more.
    """
    table = layers.resolve(name, "silver")
    rows = tables.read(spark, table).withColumn("key_bucket", _bucket(keys, buckets))
    return tables.replace(spark, table, rows, ["key_bucket"], allow_empty=True, notes={_BUCKETS: str(buckets)})


def upsert_batch(layers: Layers, name: str, keys: Sequence[str], order_by: str | None = None,
                 buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the newest row per key in a Silver table.

    A late row never replaces a newer one, and a repeated batch changes nothing. The table
    is partitioned by a hash of the key: a batch rewrites only the buckets it touches.
    ``buckets`` is for the first batch; the table keeps their number, and later batches go by
    it. ``resize_buckets`` changes it.
    """
    table: TableName = layers.resolve(name, "silver")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        layers.ensure(spark, "silver")
        present = tables.exists(spark, table)
        number = int(tables.properties(spark, table)[_BUCKETS]) if present else buckets
        # Stored strings and numbers hash alike whatever batch they come in.
        newest = latest_per_key(batch, keys, order_by).withColumn("key_bucket", _bucket(keys, number))
        if not present:
            tables.replace(spark, table, newest, ["key_bucket"], allow_empty=True, notes={_BUCKETS: str(number)})
            return
        # At most as many numbers as there are buckets.
        touched = [row[0] for row in newest.select("key_bucket").distinct().collect()]
        if touched:
            state = tables.read(spark, table).filter(F.col("key_bucket").isin(*touched))
            merged = merge_snapshots(state, newest, keys, order_by, previous_unique=True)
            tables.overwrite_partitions(spark, table, merged)

    return write
