"""Compaction of a streamed table: the many small batches of a past date become sorted files by key range.

A streamed table has a partition per date and micro-batch. ``compact_dates`` writes the batches of a date again as one
partition, cut by ranges of the key, so that a search by key skips most files by their statistics. Readers see the
batches or what was made of them, never both and never neither: the view of a streamed table shows no compacted partition
that it does not name, and one change of it hides the batches and names the new ones. The batches are deleted by the
next compaction, as queries that began before may still read them.

The newest batch of each checkpoint stays as it is, for a stream that was lost before its commit writes it again.
One writer per table: not beside a running stream. A run that dies is undone or finished by the next.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.names import TableName, run_day
from tierlake.streaming.ingest import BATCHES, STREAM_PARTITIONS

# The partitions that are shown, and the batches that were written again, as JSON.
_SHOWN, _REPLACED = "tierlake.compact", "tierlake.compacted"
_DATE, _BATCH = STREAM_PARTITIONS


def _replaced(spec: Mapping) -> str:
    """The condition of the batches that a compaction has replaced: on partition columns, for any number of batches."""
    days = ", ".join(f"DATE'{day}'" for day in spec["days"])
    made = [f"{_BATCH} = '{mark}'" for mark in spec["made"]]
    # Batches of a checkpoint are numbered, so its last one stands for all.
    streamed = [f"(split_part({_BATCH}, '-', 1) = '{name}' AND try_cast(split_part({_BATCH}, '-', 2) AS bigint) <= {last})"
                for name, last in spec["upto"].items()]
    return f"coalesce({_DATE} IN ({days}) AND ({' OR '.join([*made, *streamed])}), false)"


def _partitions(spark: SparkSession, table: TableName):
    """``(day, batch, stream, number)`` of all partitions, from the catalog."""
    text = F.col("partition")
    day = F.to_date(F.nullif(F.regexp_extract(text, f"{_DATE}=([^/]+)", 1), F.lit("__HIVE_DEFAULT_PARTITION__")))
    batch = F.regexp_extract(text, f"{_BATCH}=([^/]+)", 1)
    form = "^([0-9a-f]{16})-([0-9]+)$"
    return spark.sql(f"SHOW PARTITIONS {tables.physical(spark, table).sql}").select(
        day.alias("day"), batch.alias("batch"), F.nullif(F.regexp_extract(batch, form, 1), F.lit("")).alias("stream"),
        F.nullif(F.regexp_extract(batch, form, 2), F.lit("")).cast("bigint").alias("number"))


def _drop(spark: SparkSession, table: TableName, condition: str) -> None:
    names = _partitions(spark, table).select(F.col("day").alias(_DATE), F.col("batch").alias(_BATCH))
    # A row per small batch, as the catalog itself holds.
    for row in names.filter(condition).collect():
        tables.drop_partition(spark, table, {_DATE: row[0], _BATCH: row[1]})


def _publish(spark: SparkSession, table: TableName, shown: Sequence[str], spec: Mapping | None) -> None:
    """One change of the view: which compacted partitions are seen, and which batches no longer."""
    named = ", ".join(f"'{mark}'" for mark in shown)
    condition = f"({BATCHES} OR {_BATCH} IN ({named}))" if shown else BATCHES
    if spec:
        condition += f" AND NOT {_replaced(spec)}"
    tables.show(spark, table, condition, {_SHOWN: ",".join(shown), _REPLACED: json.dumps(spec) if spec else ""})


def _shown(spark: SparkSession, table: TableName) -> list[str]:
    """Marks of published compactions, one per run."""
    return [mark for mark in tables.properties(spark, table).get(_SHOWN, "").split(",") if mark]


def settle(spark: SparkSession, table: TableName) -> None:
    """Delete what a compaction that died has written, and the batches that the last one replaced."""
    shown = _shown(spark, table)
    named = ", ".join(f"'{mark}'" for mark in shown)
    _drop(spark, table, f"{_BATCH} LIKE 'compact-%'" + (f" AND {_BATCH} NOT IN ({named})" if shown else ""))
    replaced = tables.properties(spark, table).get(_REPLACED)
    if replaced:
        _drop(spark, table, _replaced(json.loads(replaced)))
        left = {row[0] for row in _partitions(spark, table).filter("batch LIKE 'compact-%'").select("batch").distinct().collect()}
        _publish(spark, table, [mark for mark in shown if mark in left], None)


def compact_dates(spark: SparkSession, table: TableName, keys: Sequence[str], before: str | date) -> list[date]:
    """Write the dates before a day again that have several batches; returns them. A second run finds none.

    Files are sorted by ``keys`` and sized by AQE (``advisoryPartitionSizeInBytes``); the place of a row is its last
    sort column, so a key that holds most rows is still cut. Batches that were appended without a stream stay.
    """
    if _DATE not in tables.partition_columns(spark, table):
        raise ValueError(f"{table.sql} is no streamed table")
    settle(spark, table)
    found = _partitions(spark, table)
    # One row per checkpoint.
    upto = {row[0]: row[1] - 1 for row in found.filter("stream IS NOT NULL").groupBy("stream").agg(F.max("number")).collect()}
    known = F.create_map(*(F.lit(v) for pair in upto.items() for v in pair)) if upto else F.lit(None).cast("map<string,bigint>")
    done = (F.col("number") <= F.try_element_at(known, F.col("stream"))) | F.col("batch").startswith("compact-")
    several = found.filter((F.col("day") < F.lit(run_day(before))) & done).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.collect_list(F.when(F.col("stream").isNull(), F.col("batch"))).alias("made"))
    chosen = several.filter("n > 1").orderBy("day").collect()
    if not chosen:
        return []
    days = [row["day"] for row in chosen]
    spec = {"days": [str(day) for day in days], "upto": upto, "made": sorted({m for row in chosen for m in row["made"]})}
    old, mark = _replaced(spec), f"compact-{uuid.uuid4().hex[:16]}"
    shown = _shown(spark, table)
    if not shown:
        # A table that was made before views hid compacted partitions.
        _publish(spark, table, [], None)
    rows = spark.table(tables.physical(spark, table).sql).filter(old)
    order = [_DATE, _BATCH, *keys, "_place"]
    ranged = (rows.withColumns({_BATCH: F.lit(mark), "_place": F.monotonically_increasing_id()})
              .repartitionByRange(*order).sortWithinPartitions(*order).drop("_place"))
    written = tables.overwrite_partitions(spark, table, ranged, rebalance=False, indexed=True, verify="rows")
    wanted = rows.count()  # from footers
    if written != wanted:
        raise tables.Mismatch(f"{wanted} rows of {table.sql} became {written}")
    _publish(spark, table, [*shown, mark], spec)
    return days
