"""Closed minutes: a landed minute goes to the Lake once the watermark says that no more is awaited.

Three streams over the landing area follow each other, each with a checkpoint of its own below ``state``:

* arrivals: every landed file once, with the minute of its folder, from the listing; no content is read.
* closing: files per event-time window, in append mode. What leaves it are the files of minutes that the watermark has
  passed; only their lines are read, and go to the Lake. Its state holds one row per file of an open minute.
* late files: an arrival whose minute was closed before it came is dropped by the watermark. Its lines go to the table of
  rejects with the minute they missed.

A file holds one minute and belongs to one micro-batch, so it is taken or late as a whole. Every step names what it
writes after its checkpoint and batch, so a step that runs again after a failure replaces what it wrote, and the next
step begins when the one before has committed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tierlake.contract import Contract
from tierlake.functions.privacy import Keys
from tierlake.names import Layers, job_name
from tierlake.streaming.ingest import _append_batch as append_batch, checkpoint_id, publish_batch

FILE = "file string, minute timestamp"


def _minute(path: Column) -> Column:
    """The UTC minute that a landing folder stands for, null outside such folders."""
    form = r"date=(\d{4}-\d\d-\d\d)/hour=(\d\d)/minute=(\d\d)/[^/]*$"
    parts = [F.regexp_extract(path, form, group) for group in (1, 2, 3)]
    text = F.concat(parts[0], F.lit(" "), parts[1], F.lit(":"), parts[2])
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))


def _run(writer: DataStreamWriter, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _arrivals(spark: SparkSession, path: str, max_files: int | None) -> DataFrame:
    kinds = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(kinds).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # Of the file only its name: the content column is pruned, so no file is opened.
    name = F.col("_metadata.file_path")
    return reader.load(path).select(name.alias("file"), _minute(name).alias("minute"))


def closing(arrivals: DataFrame, delay: str) -> DataFrame:
    """A stream of ``(file, minute)``: the files of each minute that has been closed."""
    window = F.window("minute", "1 minute")
    counted = arrivals.withWatermark("minute", delay).groupBy(window, "file").agg(F.count(F.lit(1)).alias("times"))
    return counted.select("file", F.col("window.start").alias("minute"))


def _lines(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """``(value, file, minute)`` of files; only the folders of their minutes are listed."""
    # As many as minutes were closed since the last batch.
    minutes = [row[0] for row in files.select(
        F.date_format("minute", "'date='yyyy-MM-dd'/hour='HH'/minute='mm")).distinct().collect()]
    if not minutes:
        return spark.createDataFrame([], f"value string, {FILE}")
    lines = spark.read.option("recursiveFileLookup", True).text([f"{path.rstrip('/')}/{part}" for part in minutes])
    return lines.select("value", F.col("_metadata.file_path").alias("file")).join(files.select("file", "minute"), "file")


def close_minutes(spark: SparkSession, path: str, layers: Layers, app: str, contract: Contract, state: str, *,
                  delay: str = "1 minute", ingest_date: str | None = None, keys: Keys = Keys(),
                  max_files: int | None = None, strict: bool = False) -> None:
    """Take what has landed at ``path`` as far as its minutes are closed; to be run from time to time.

    ``path`` is written by ``land_minutes`` at minute grain or by ``land_packets`` (its ``status=accepted``). A minute
    is closed when a file of a minute that began at least ``delay`` after its end has arrived and a batch of arrivals
    (``max_files``) has ended; until then its files wait, whatever the time of day. Lines of a minute closed before they came go to
    ``<app>_rejected`` with the reason ``late: <minute>``, those of files outside the folders of minutes are left. Faulty
    lines go there too, or with ``strict`` fail the run. Otherwise like ``ingest_stream``.
    """
    layers.ensure(spark, "lake")
    if ingest_date is None and contract.order_by is None:
        raise ValueError("Give an ingest_date, or a contract with a timestamp column")
    state = state.rstrip("/")
    arrived, taken = f"{state}/arrivals", f"{state}/closed"
    _run(_arrivals(spark, path, max_files).writeStream.format("parquet").option("path", arrived), f"{state}/arriving")

    append = append_batch(layers, app, contract, keys, ingest_date, f"{state}/closing", strict)

    def close(batch: DataFrame, epoch: int) -> None:
        # Written first: the Lake is filled from it, and late files are those that it lacks.
        place = f"{taken}/batch={epoch}"
        batch.write.mode("overwrite").parquet(place)
        files = spark.read.schema(FILE).parquet(place)
        if not files.isEmpty():
            append(_lines(spark, path, files).select("value"), epoch)

    stream = spark.readStream.schema(FILE).parquet(arrived)
    _run(closing(stream, delay).writeStream.outputMode("append").foreachBatch(close), f"{state}/closing")

    # Both are done with all arrivals here, so the watermark is the latest minute less the delay.
    latest = spark.read.schema(FILE).parquet(arrived).agg(F.max("minute")).first()[0]
    if latest is None:
        return
    refused = layers.resolve(job_name(f"{app}_rejected"), "lake")

    def refuse(batch: DataFrame, epoch: int) -> None:
        passed = F.lit(latest) - F.expr(f"interval {delay}")
        behind = batch.filter(F.col("minute") + F.expr("interval 1 minute") <= passed)
        # Only what was closed in the minutes at hand can hold them; the files' statistics skip the rest.
        first = behind.agg(F.min("minute")).first()[0]
        if first is None:
            return
        known = spark.read.schema(FILE).parquet(taken).filter(F.col("minute") >= F.lit(first))
        late = behind.join(known.select("file"), "file", "left_anti")
        lines = _lines(spark, path, late)
        mark = F.lit(f"{checkpoint_id(spark, f'{state}/late')}-{epoch}")
        day = F.to_date("minute") if ingest_date is None else F.to_date(F.lit(str(ingest_date)))
        reason = F.concat(F.lit("late: "), F.date_format("minute", "yyyy-MM-dd HH:mm"))
        rows = lines.select("value", reason.alias("reason"), day.alias("ingest_date"), mark.alias("stream_batch"))
        if not late.isEmpty():
            publish_batch(spark, refused, rows)

    stream = spark.readStream.schema(FILE).parquet(arrived)
    _run(stream.writeStream.foreachBatch(refuse), f"{state}/late")
