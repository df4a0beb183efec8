"""Raw events landed as JSON lines in directories of their UTC minute of receipt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierlake.sources.market import RECORD, json_columns, tag_packets

# Partition directories of the landing area, coarse to fine.
LEVELS = {"date": "yyyy-MM-dd", "hour": "HH", "minute": "mm"}


def _levels(grain: str) -> list[str]:
    if grain not in LEVELS:
        raise ValueError(f"The grain must be one of {sorted(LEVELS)}")
    return list(LEVELS)[: list(LEVELS).index(grain) + 1]


def landed_columns(df: DataFrame, time: str, levels: Sequence[str]) -> list[Column]:
    return json_columns(df) + [F.date_format(time, LEVELS[level]).alias(level) for level in levels]


def land_minutes(df: DataFrame, path: str, checkpoint: str | None = None, *, time: str = "received_at",
                 grain: str = "minute", interval: str | None = "5 seconds") -> StreamingQuery | None:
    """Write a batch or a stream of events to ``path/date=/hour=/minute=``.

    A stream commits a micro-batch every ``interval``, or with ``None`` handles what is there
    and ends. Its checkpoint takes the place of a spool: a batch that was not committed
    is written again. ``grain`` may be coarser where minutes would make tiny files.
    """
    levels = _levels(grain)
    rows = df.select(*landed_columns(df, time, levels))
    if not df.isStreaming:
        shaped = rows.hint("rebalance", *(F.col(level) for level in levels))
        shaped.write.mode("append").partitionBy(*levels).option("ignoreNullFields", False).json(path)
        return None
    if checkpoint is None:
        raise ValueError("A streaming landing needs a checkpoint folder")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        rows.writeStream.format("json").partitionBy(*levels).option("ignoreNullFields", False)
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def land_packets(packets: DataFrame, path: str, checkpoint: str, *, interval: str | None = "5 seconds",
                 source: str = "broker") -> StreamingQuery:
    """A stream of packets, normalised once, to ``path/status=/date=/hour=/minute=``.

    ``packets`` are ``(payload, batch_id, sequence, received_at)`` rows; the batch id stays the
    same when a file is read again, and the event ids with it. ``status=accepted`` has the
    market records, ``status=rejected`` the payloads with their reasons. One file sink
    commits both, so neither is lost or doubled after a failure.
    """
    tagged = tag_packets(packets, source)
    good = F.col("reason").isNull()
    records = tagged.select(*RECORD)
    accepted = F.to_json(F.struct(*json_columns(records)), {"ignoreNullFields": "false"})
    refused = F.to_json(F.struct("payload", "batch_id", "sequence", "received_at", "reason"))
    value = F.when(good, accepted).otherwise(refused).alias("value")
    status = F.when(good, "accepted").otherwise("rejected").alias("status")
    parts = [F.date_format("received_at", form).alias(level) for level, form in LEVELS.items()]
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        tagged.select(value, status, *parts).writeStream.format("text").partitionBy("status", *LEVELS)
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def minute_counts(df: DataFrame, time: str = "received_at") -> DataFrame:
    """Events per minute of receipt."""
    minute = F.date_trunc("minute", time).alias("minute")
    return df.groupBy(minute).agg(F.count(F.lit(1)).alias("events"))


def minute_glob(path: str, moment) -> str:
    """The files of one closed UTC minute."""
    parts = (f"date={moment:%Y-%m-%d}", f"hour={moment:%H}", f"minute={moment:%M}", "*.json")
    return "/".join((path.rstrip("/"), *parts))
