"""Landing by minute, restart, replay, late data."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.plans.bronze import bronze_full
from tierlake.sources.files import read_files
from tierlake.sources.market import to_event_json
from tierlake.plans.lake import ingest
from tierlake.streaming.ingest import dedup_stream, ingest_stream, resize_buckets, upsert_batch
from tierlake.streaming.landing import land_minutes, minute_counts, minute_glob

START = datetime(2026, 10, 25, 9, 15)
SCHEMA = "event_id string, price double, received_at timestamp"


def events(spark, ids, minutes=0):
    data = [(f"e{i}", float(i), START + timedelta(minutes=minutes, seconds=20 * i)) for i in ids]
    ntz = SCHEMA.replace("timestamp", "timestamp_ntz")
    return spark.createDataFrame(data, ntz).withColumn("received_at", F.col("received_at").cast("timestamp"))


@pytest.fixture
def contract(sheet):
    return sheet([("event_id", "string"), ("price", "double"), ("received_at", "timestamp")], ["event_id"], "received_at")


def folders(path):
    return sorted(os.path.relpath(root, path) for root, _, files in os.walk(path) if any(f.startswith("part") for f in files))


def test_batch_landing(spark, tmp_path, contract):
    land_minutes(events(spark, range(6)), f"{tmp_path}/raw")
    assert folders(tmp_path / "raw") == ["date=2026-10-25/hour=09/minute=15", "date=2026-10-25/hour=09/minute=16"]
    path = minute_glob(f"{tmp_path}/raw", START)
    one = contract.cast(read_files(spark, path, contract))
    assert rows(one, "event_id", "price") == [("e0", 0.0), ("e1", 1.0), ("e2", 2.0)]
    assert one.filter("received_at = '2026-10-25T09:15:20Z'").count() == 1
    assert spark.read.text(path).filter("value LIKE '%\"received_at\":\"2026-10-25T09:15:20Z\"%'").count() == 1
    counts = minute_counts(events(spark, range(7)))
    assert sorted(r.events for r in counts.collect()) == [1, 3, 3]


def test_stream_landing_and_restart(spark, tmp_path, layers, contract):
    source = f"{tmp_path}/in"
    events(spark, range(4)).write.parquet(source)

    def land():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        land_minutes(stream, f"{tmp_path}/raw", f"{tmp_path}/c1", interval=None).awaitTermination()

    def ingest(checkpoint="c2"):
        ingest_stream(spark, f"{tmp_path}/raw", layers, "ticks", contract, f"{tmp_path}/{checkpoint}",
                      ingest_date="2026-10-25").awaitTermination()
        return tables.read(spark, layers.resolve("ticks", "lake"))

    land(), land()
    assert ingest().count() == 4
    assert ingest().count() == 4
    events(spark, range(4, 6)).write.mode("append").parquet(source)
    land()
    assert ingest().count() == 6
    assert ingest("replay").count() == 12
    assert bronze_full(spark, layers, "ticks", "2026-10-25", contract) == 6


def test_a_repeated_batch_replaces_itself(spark, tmp_path, layers, contract):
    from tierlake.functions.privacy import Keys
    from tierlake.streaming.ingest import _append_batch

    layers.ensure(spark, "lake")
    def writer(number):
        checkpoint = tmp_path / f"c{number}"
        checkpoint.mkdir()
        (checkpoint / "metadata").write_text(f'{{"id":"{number:08d}-0000-0000-0000-000000000000"}}')
        return _append_batch(layers, "ticks", contract, Keys(), None, str(checkpoint), False)

    def found():
        return tables.read(spark, layers.resolve("ticks", "lake"))

    write = writer(1)
    for epoch, ids in ((0, range(3)), (1, range(3, 5)), (1, range(3, 5))):
        write(to_event_json(events(spark, ids)), epoch)
    assert found().count() == 5 and found().select("ingest_date").distinct().count() == 1
    # A checkpoint made anew begins at 0 again, and must not replace what the old one wrote.
    writer(2)(to_event_json(events(spark, range(5, 7))), 0)
    assert found().count() == 7 and "stream_batch" not in found().columns
    # Batches can be appended to a streamed table.
    ingest(spark, layers, "ticks", events(spark, range(7, 8)).select(*contract.names), contract, "2026-10-25", "append")
    assert found().count() == 8


def test_faulty_lines_are_set_apart(spark, tmp_path, layers, contract):
    raw = tmp_path / "raw"
    raw.mkdir()
    good = to_event_json(events(spark, range(2))).collect()
    (raw / "a.json").write_text("\n".join([*(r.value for r in good), "{broken", '{"event_id": "x", "more": 1}']) + "\n")

    def run(name, strict):
        ingest_stream(spark, str(raw), layers, name, contract, f"{tmp_path}/{name}", ingest_date="2026-10-25",
                      strict=strict).awaitTermination()

    run("ticks", False)
    assert tables.read(spark, layers.resolve("ticks", "lake")).count() == 2
    refused = tables.read(spark, layers.resolve("ticks_rejected", "lake"))
    assert rows(refused, "value", "reason") == [
        ('{"event_id": "x", "more": 1}', "undeclared: more"), ("{broken", "unparsable")]
    with pytest.raises(Exception, match="refused"):
        run("strict", True)


def test_another_number_of_buckets_is_not_mixed_in(spark, layers):
    for buckets in (4, 16):
        upsert_batch(layers, "state", ["event_id"], "received_at", buckets)(events(spark, range(40)), 0)
    table = layers.resolve("state", "silver")
    assert tables.read(spark, table).count() == 40
    assert resize_buckets(spark, layers, "state", ["event_id"], 9) == 40
    upsert_batch(layers, "state", ["event_id"], "received_at")(events(spark, range(50), 1), 0)
    assert tables.read(spark, table).count() == 50
    assert tables.read(spark, table).agg(F.max("key_bucket")).first()[0] < 9


def test_dedup(spark, tmp_path):
    source = f"{tmp_path}/in"
    for minutes in (0, 0, 30):
        events(spark, range(3), minutes).write.mode("append").parquet(source)

    def run(name, *args):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        query = (dedup_stream(stream, "event_id", *args).writeStream.format("parquet")
                 .option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/c-{name}")
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/{name}").count()

    assert run("exact") == 3
    assert run("bounded", "received_at", "2 hours") == 3
    with pytest.raises(ValueError):
        dedup_stream(events(spark, range(1)), "event_id", delay="1 hour")


def test_upsert_ignores_late_and_repeated_rows(spark, layers):
    write = upsert_batch(layers, "state", ["event_id"], "received_at", buckets=4)

    def batch(ids, minutes, price):
        return events(spark, ids, minutes).withColumn("price", F.lit(price))

    for ids, minutes, price in ((range(6), 10, 1.0), (range(3, 9), 20, 2.0), (range(9), 0, 3.0), (range(3, 9), 20, 2.0)):
        write(batch(ids, minutes, price), 0)
    found = tables.read(spark, layers.resolve("state", "silver"))
    assert {r.event_id: r.price for r in found.collect()} == {f"e{i}": 1.0 if i < 3 else 2.0 for i in range(9)}


def test_landing_needs_a_checkpoint_and_a_known_grain(spark, tmp_path):
    with pytest.raises(ValueError, match="grain"):
        land_minutes(events(spark, range(1)), f"{tmp_path}/raw", grain="second")
    events(spark, range(1)).write.parquet(f"{tmp_path}/in")
    with pytest.raises(ValueError, match="checkpoint"):
        land_minutes(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), f"{tmp_path}/raw")


def test_state_survives_restarts_and_lost_publications(spark, tmp_path, layers):
    from tierlake.streaming.state import keep_state, publish_state, read_state

    source, keys = f"{tmp_path}/in", ["event_id"]
    table, changes = layers.resolve("state", "silver"), layers.resolve("state_changes", "silver")

    def arrive(ids, minutes, price):
        events(spark, ids, minutes).withColumn("price", F.lit(price)).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        keep_state(stream, layers, "state", keys, f"{tmp_path}/c", "received_at").awaitTermination()
        return {r.event_id: r.price for r in read_state(spark, layers, "state", keys, "received_at").collect()}

    arrive(range(6), 10, 1.0), arrive(range(3, 9), 20, 2.0)
    expected = {f"e{i}": 1.0 if i < 3 else 2.0 for i in range(9)}
    assert run() == expected
    # Each batch wrote the keys it met, and no more.
    assert [r[0] for r in tables.read(spark, changes).groupBy("stream_batch").count().orderBy("stream_batch").select("count").collect()] == [6, 6]
    assert publish_state(spark, layers, "state", keys, "received_at") == 9
    assert tables.read(spark, changes).count() == 0
    # Late rows, after a restart: the state knows better. They change nothing.
    arrive(range(9), 0, 3.0)
    assert run() == expected
    # A publication that was lost after its new version: the changes go in again.
    before = rows(tables.read(spark, changes))
    publish_state(spark, layers, "state", keys, "received_at")
    tables.append(spark, changes, spark.createDataFrame(before, tables.read(spark, changes).schema))
    assert run() == expected and publish_state(spark, layers, "state", keys, "received_at") == 9
    assert {r.event_id: r.price for r in tables.read(spark, table).collect()} == expected


def test_a_lost_driver_leaves_a_usable_table(spark, layers, monkeypatch):
    write = upsert_batch(layers, "state", ["event_id"], "received_at", buckets=4)

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "set_property", lost)
        write(events(spark, range(5)), 0)
        assert resize_buckets(spark, layers, "state", ["event_id"], 7) == 5
    write(events(spark, range(8), 1), 1)
    assert tables.read(spark, layers.resolve("state", "silver")).count() == 8


def test_faultless_lines_are_read_once(spark, tmp_path, layers, contract, monkeypatch):
    land_minutes(events(spark, range(4)), f"{tmp_path}/raw")

    def again(self):
        raise AssertionError("the lines are read again")

    monkeypatch.setattr(type(spark.range(1)), "isEmpty", again)
    ingest_stream(spark, f"{tmp_path}/raw", layers, "ticks", contract, f"{tmp_path}/c",
                  ingest_date="2026-10-25").awaitTermination()
    assert tables.read(spark, layers.resolve("ticks", "lake")).count() == 4
