"""Closed minutes: what is taken, what waits, what is late, and failures between the steps."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.streaming import minutes
from tierlake.streaming.landing import land_minutes

START = datetime(2026, 10, 25, 9, 15)


@pytest.fixture
def contract(sheet):
    return sheet([("event_id", "string"), ("received_at", "timestamp")], ["event_id"], "received_at")


def land(spark, path, *events):
    """Events ``(id, minute)``; a minute is counted from the start."""
    data = [(name, START + timedelta(minutes=minute, seconds=5)) for name, minute in events]
    df = spark.createDataFrame(data, "event_id string, received_at timestamp_ntz")
    land_minutes(df.withColumn("received_at", F.col("received_at").cast("timestamp")), path)


def ids(spark, layers, name="ticks"):
    table = layers.resolve(name, "lake")
    return [r[0] for r in rows(tables.read(spark, table), "event_id")] if tables.exists(spark, table) else []


def late(spark, layers):
    table = layers.resolve("ticks_rejected", "lake")
    if not tables.exists(spark, table):
        return []
    return rows(tables.read(spark, table).select(F.get_json_object("value", "$.event_id"), "reason"))


def test_minutes_close_wait_and_are_missed(spark, tmp_path, layers, contract):
    raw, state = f"{tmp_path}/raw", f"{tmp_path}/state"

    def run():
        minutes.close_minutes(spark, raw, layers, "ticks", contract, state, delay="2 minutes")
        return ids(spark, layers)

    land(spark, raw, ("a", 0), ("b", 0), ("c", 1), ("d", 3))
    assert run() == ["a", "b"]           # minute 0 ends at 1, and 3 - 2 = 1 has come
    assert run() == ["a", "b"]           # nothing new: nothing is taken twice
    land(spark, raw, ("e", 0), ("f", 1), ("g", -500))
    assert run() == ["a", "b"] and late(spark, layers) == [
        ("e", "late: 2026-10-25 09:15"), ("g", "late: 2026-10-25 00:55")]
    land(spark, raw, ("h", 9))
    assert run() == ["a", "b", "c", "d", "f"]
    assert len(late(spark, layers)) == 2
    day = tables.read(spark, layers.resolve("ticks", "lake"))
    assert {str(r[0]) for r in day.select("ingest_date").collect()} == {"2026-10-25"}


def test_a_step_that_fails_is_taken_up(spark, tmp_path, layers, contract, monkeypatch):
    raw, state = f"{tmp_path}/raw", f"{tmp_path}/state"
    land(spark, raw, ("a", 0), ("b", 1), ("c", 9))

    def fails_after(function):
        def write(*args):
            function(*args)
            raise RuntimeError("lost")
        return write

    def run():
        minutes.close_minutes(spark, raw, layers, "ticks", contract, state, delay="0 minutes")

    with monkeypatch.context() as patch:
        make = minutes.append_batch
        patch.setattr(minutes, "append_batch", lambda *args: fails_after(make(*args)))
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert ids(spark, layers) == ["a", "b"]
    land(spark, raw, ("d", 0))
    with monkeypatch.context() as patch:
        patch.setattr(minutes, "publish_batch", fails_after(minutes.publish_batch))
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert ids(spark, layers) == ["a", "b"]
    assert [name for name, _ in late(spark, layers)] == ["d"]


def test_nothing_landed_and_files_elsewhere(spark, tmp_path, layers, contract):
    raw, state = tmp_path / "raw", f"{tmp_path}/state"
    raw.mkdir()
    minutes.close_minutes(spark, str(raw), layers, "ticks", contract, state)
    (raw / "note.txt").write_text("no event\n")
    land(spark, str(raw), ("a", 0), ("b", 1), ("c", 2))
    minutes.close_minutes(spark, str(raw), layers, "ticks", contract, state, delay="0 minutes")
    assert ids(spark, layers) == ["a", "b"] and late(spark, layers) == []


def test_state_is_a_row_per_open_file(spark, tmp_path, layers, contract):
    raw, state = f"{tmp_path}/raw", f"{tmp_path}/state"
    land(spark, raw, *((f"e{i}", i % 30) for i in range(300)))
    minutes.close_minutes(spark, raw, layers, "ticks", contract, state, delay="3 minutes", max_files=500)
    assert len(ids(spark, layers)) == 260
    left = spark.read.format("statestore").load(f"{state}/closing")
    assert left.count() == spark.read.parquet(f"{state}/arrivals").filter(
        F.col("minute") >= F.lit(START + timedelta(minutes=26))).count()
