"""Structured Streaming: landing, incremental ingest, replay and late data."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import EVENT_COLUMNS, EVENTS, EVENTS_BY_ID, contract, layers, load, query, stamp
from catalogue.market import packets, record_sql, ticks_sql
from tierlake import tables
from tierlake.plans.bronze import bronze_full
from tierlake.session import workspace
from tierlake.streaming.compaction import compact_dates
from tierlake.streaming.ingest import dedup_stream, ingest_stream, upsert_batch
from tierlake.sources.market import TICK_KEY, market_contract
from tierlake.streaming.state import keep_state, publish_state, read_state
from tierlake.streaming.minutes import close_minutes
from tierlake.streaming.landing import land_minutes, land_packets, minute_counts


def event_stream(spark, sf):
    schema = load(spark, sf, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
            .withColumn("ts", F.col("ts").cast("timestamp")))


def landed(spark, sf):
    """Run the landing stream over the events and return the folder."""
    folder = workspace(spark, "landing")
    land_minutes(event_stream(spark, sf), f"{folder}/events", f"{folder}/checkpoint",
                 time="ts", grain="date", interval=None).awaitTermination()
    return folder


@query("SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S.%f') AS minute, count(*) AS events "
       "FROM events GROUP BY 1")
def stream_minute_counts(spark, sf):
    folder = landed(spark, sf)
    events = spark.read.schema(contract(spark, EVENTS).text_schema()).json(f"{folder}/events")
    return minute_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts")


@query(f"SELECT {EVENT_COLUMNS}, '2024-01-31' AS snapshot_date FROM events")
def stream_replay_dedup(spark, sf):
    # The landed events are ingested twice; the snapshot has each event once.
    folder, sheet, space = landed(spark, sf), contract(spark, EVENTS_BY_ID), layers(spark)
    for run in ("first", "replay"):
        ingest_stream(spark, f"{folder}/events", space, "events", sheet, f"{folder}/{run}",
                      ingest_date="2024-01-31").awaitTermination()
    bronze_full(spark, space, "events", "2024-01-31", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


@query(f"SELECT {EVENT_COLUMNS} FROM events UNION ALL SELECT {EVENT_COLUMNS} FROM events")
def stream_ingest_twice(spark, sf):
    folder, sheet, space = landed(spark, sf), contract(spark, EVENTS_BY_ID), layers(spark)
    for run in ("first", "first", "replay"):
        ingest_stream(spark, f"{folder}/events", space, "events", sheet, f"{folder}/{run}",
                      max_files=10).awaitTermination()
    return tables.read(spark, space.resolve("events", "lake")).drop("ingest_date")


@query(f"SELECT {EVENT_COLUMNS} FROM events UNION ALL SELECT {EVENT_COLUMNS} FROM events")
def stream_compacted(spark, sf):
    # Past dates are compacted after each of two ingests; the second adds rows to compacted dates.
    folder, sheet, space = landed(spark, sf), contract(spark, EVENTS_BY_ID), layers(spark)
    table = space.resolve("events", "lake")
    for run in ("first", "replay"):
        ingest_stream(spark, f"{folder}/events", space, "events", sheet, f"{folder}/{run}",
                      max_files=10).awaitTermination()
        compact_dates(spark, table, ["event_id"], "2024-01-21")
    return tables.read(spark, table).drop("ingest_date")


@query(f"SELECT DISTINCT {EVENT_COLUMNS}, '2024-01-31' AS snapshot_date FROM events")
def stream_replay_without_keys(spark, sf):
    # A contract without keys keeps distinct rows; the replay adds none.
    folder, space = landed(spark, sf), layers(spark)
    sheet = contract(spark, EVENTS.replace(" key", "").replace("timestamp time", "timestamp"))
    for run in ("first", "replay"):
        ingest_stream(spark, f"{folder}/events", space, "events", sheet, f"{folder}/{run}",
                      ingest_date="2024-01-31").awaitTermination()
    bronze_full(spark, space, "events", "2024-01-31", sheet)
    return tables.read(spark, space.resolve("events", "bronze"))


@query("""
SELECT CASE event_id % 3 WHEN 1 THEN 'unparsable' ELSE 'undeclared: more' END AS reason, count(*) AS n
FROM events WHERE event_id % 3 <> 0 GROUP BY 1 UNION ALL SELECT 'accepted', count(*) FROM events WHERE event_id % 3 = 0
""")
def stream_rejects(spark, sf):
    # Of three lines one is cut off and one has a field that the contract does not know.
    folder, space = workspace(spark, "faulty"), layers(spark)
    line = F.format_string('{"event_id": %d, "kind": "%s"}', "event_id", "event_type")
    more = F.format_string('{"event_id": %d, "kind": "%s", "more": 1}', "event_id", "event_type")
    kind = F.col("event_id") % 3
    lines = load(spark, sf, "events").select(
        F.when(kind == 0, line).when(kind == 1, F.substring(line, 1, 20)).otherwise(more).alias("value"))
    lines.write.text(f"{folder}/raw")
    sheet = contract(spark, "event_id bigint key\nkind string")
    ingest_stream(spark, f"{folder}/raw", space, "lines", sheet, f"{folder}/checkpoint",
                  ingest_date="2024-01-31").awaitTermination()
    good = tables.read(spark, space.resolve("lines", "lake")).select(F.lit("accepted").alias("reason"))
    bad = tables.read(spark, space.resolve("lines_rejected", "lake")).select("reason")
    return good.unionByName(bad).groupBy("reason").agg(F.count("*").alias("n"))


# The month runs 432 times as fast, so that its packets come in a hundred minutes, each at a time of its own.
FAST = "make_timestamp(1705276800000000 + (epoch_us(ts) - 1704067200000000) // 432)"


@query(f"""
SELECT *, '2024-01-31' AS snapshot_date FROM ({ticks_sql(FAST)} AND event_id % 7 <> 0)
UNION ALL SELECT {record_sql(security_id="'rejected'", sequence="count(*)")}, NULL FROM events
WHERE event_id % 7 = 0 OR event_type <> 'error' AND (user_id % 5 = 4 OR user_id <= 0)
""")
def stream_packets_to_bronze(spark, sf):
    # Packets, some cut off, are normalised and landed by the minute of their receipt, then
    # ingested twice.
    folder, space, sheet = workspace(spark, "packets"), layers(spark), market_contract(TICK_KEY)
    cut = F.when(F.col("sequence") % 7 == 0, F.substring("payload", 1, 9)).otherwise(F.col("payload"))
    fast = F.expr("timestamp_micros(1705276800000000 + (unix_micros(received_at) - 1704067200000000) div 432)")
    made = packets(spark, sf).withColumns({"payload": cut, "received_at": fast})
    made.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(made.schema).parquet(f"{folder}/in")
    land_packets(stream, f"{folder}/raw", f"{folder}/landing", interval=None).awaitTermination()
    for run in ("first", "replay"):
        ingest_stream(spark, f"{folder}/raw/status=accepted", space, "ticks", sheet, f"{folder}/{run}",
                      ingest_date="2024-01-31").awaitTermination()
    bronze_full(spark, space, "ticks", "2024-01-31", sheet)
    good = tables.read(spark, space.resolve("ticks", "bronze"))
    bad = spark.read.text(f"{folder}/raw/status=rejected").agg(F.count("*").alias("sequence"))
    return good.unionByName(bad.withColumn("security_id", F.lit("rejected")), allowMissingColumns=True)


@query(f"""
WITH timed AS (SELECT * REPLACE ({FAST} AS ts), date_trunc('minute', {FAST}) AS minute, event_id % 11 = 0 AS second FROM events),
ends AS (SELECT max(minute) AS whole, max(minute) FILTER (NOT second) AS before FROM timed)
SELECT {EVENT_COLUMNS}, CASE WHEN second AND minute <= before - INTERVAL 6 MINUTE
  THEN strftime(minute, 'late: %Y-%m-%d %H:%M') ELSE 'taken' END AS outcome
FROM timed, ends WHERE minute <= whole - INTERVAL 6 MINUTE
""")
def stream_closed_minutes(spark, sf):
    # Of a hundred minutes, those five minutes behind the last are closed. Then one event in eleven
    # comes, too late for these, and the closing runs again.
    folder, space, sheet = workspace(spark, "minutes"), layers(spark), contract(spark, EVENTS_BY_ID)
    fast = F.expr("timestamp_micros(1705276800000000 + (unix_micros(ts) - 1704067200000000) div 432)")
    made = load(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("ts", fast)
    second = F.col("event_id") % 11 == 0
    for part in (made.filter(~second), made.filter(second)):
        land_minutes(part, f"{folder}/raw", time="ts")
        close_minutes(spark, f"{folder}/raw", space, "events", sheet, f"{folder}/state", delay="5 minutes")
    good = tables.read(spark, space.resolve("events", "lake")).drop("ingest_date")
    bad = tables.read(spark, space.resolve("events_rejected", "lake"))
    lines = bad.select("reason", F.from_json("value", sheet.text_schema()).alias("row")).select("reason", "row.*")
    late = sheet.cast(lines).withColumnRenamed("reason", "outcome")
    return good.withColumn("outcome", F.lit("taken")).unionByName(late)


@query(f"SELECT {EVENT_COLUMNS} FROM events")
def stream_dedup(spark, sf):
    folder = workspace(spark, "dedup")
    twice = event_stream(spark, sf).unionByName(event_stream(spark, sf))
    (dedup_stream(twice, "event_id").writeStream.format("parquet").option("path", f"{folder}/out")
     .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{folder}/out")


@query(f"""
SELECT {EVENT_COLUMNS} FROM
 (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
""")
def stream_upsert(spark, sf):
    # The files of the days come in several batches, in no particular order of days, and the
    # stream is started again after a publication.
    folder, space = landed(spark, sf), layers(spark)
    sheet, keys = contract(spark, EVENTS), ["user_id", "event_type"]
    stream = (spark.readStream.schema(sheet.text_schema()).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", 16).json(f"{folder}/events"))
    for _ in range(2):
        keep_state(sheet.cast(stream), space, "state", keys, f"{folder}/state", "ts").awaitTermination()
        publish_state(spark, space, "state", keys, "ts")
    return read_state(spark, space, "state", keys, "ts")


@query(f"""
SELECT {EVENT_COLUMNS} FROM
 (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1)
""")
def stream_upsert_buckets(spark, sf):
    # The files of the days come in several batches, in no particular order of days.
    folder, space = landed(spark, sf), layers(spark)
    sheet = contract(spark, EVENTS)
    stream = (spark.readStream.schema(sheet.text_schema()).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", 8).json(f"{folder}/events"))
    (sheet.cast(stream).writeStream
     .foreachBatch(upsert_batch(space, "state", ["user_id", "event_type"], "ts", buckets=8))
     .option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
     .start().awaitTermination())
    return tables.read(spark, space.resolve("state", "silver")).drop("key_bucket")
