"""Compaction of streamed dates: same rows, fewer files, sorted, and safe against failures and readers."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.streaming import compaction
from tierlake.streaming.ingest import ingest_stream

START = datetime(2026, 10, 25, 9)


@pytest.fixture
def streamed(spark, tmp_path, layers, sheet):
    """A table of two dates, streamed file by file; returns ``(table, feed)``."""
    contract = sheet([("id", "bigint"), ("at", "timestamp")], ["id"], "at")
    table = layers.resolve("ticks", "lake")

    def feed(files, shift=0, name="c"):
        for number in range(files):
            lines = [((i * 7 + number) % 50, START + timedelta(days=i % 2, minutes=number + shift)) for i in range(20)]
            df = spark.createDataFrame(lines, "id bigint, at timestamp_ntz").withColumn("at", F.col("at").cast("timestamp"))
            df.coalesce(1).write.mode("append").json(f"{tmp_path}/raw")
        ingest_stream(spark, f"{tmp_path}/raw", layers, "ticks", contract, f"{tmp_path}/{name}",
                      max_files=1).awaitTermination()

    feed(5)
    return table, feed


def parts(spark, table):
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {tables.physical(spark, table).sql}").collect()]


def test_same_rows_in_sorted_ranges(spark, streamed):
    table, feed = streamed
    before = rows(tables.read(spark, table))
    reader = tables.read(spark, table).filter("id < 25")
    assert len(parts(spark, table)) == 10
    assert compaction.compact_dates(spark, table, ["id"], "2026-10-26") == [date(2026, 10, 25)]
    assert rows(tables.read(spark, table)) == before
    assert reader.count() == sum(1 for r in before if r[0] < 25)
    # Four committed batches became one partition; the newest stays, and so does the other date.
    assert compaction.compact_dates(spark, table, ["id"], "2026-10-26") == []
    assert len([p for p in parts(spark, table) if "2026-10-25" in p]) == 2
    assert len([p for p in parts(spark, table) if "2026-10-26" in p]) == 5
    assert rows(tables.read(spark, table)) == before
    assert tables.read(spark, table).columns == ["id", "at", "ingest_date"]
    made = spark.table(tables.physical(spark, table).sql).filter("stream_batch LIKE 'compact-%'")
    for file in made.inputFiles():
        found = [r[0] for r in spark.read.parquet(file).select("id").collect()]
        assert found == sorted(found)


def test_late_batches_of_a_compacted_date(spark, streamed):
    table, feed = streamed
    compaction.compact_dates(spark, table, ["id"], "2026-10-27")
    feed(2, shift=30)
    assert tables.read(spark, table).count() == 140
    assert compaction.compact_dates(spark, table, ["id"], "2026-10-27") == [date(2026, 10, 25), date(2026, 10, 26)]
    feed(1, shift=40, name="again")
    assert tables.read(spark, table).count() == 140 + 160
    compaction.settle(spark, table)
    assert tables.read(spark, table).count() == 300
    assert compaction.compact_dates(spark, table, ["id"], "2026-10-24") == []


@pytest.mark.parametrize("step", ["write", "switch", "delete"])
def test_a_run_that_dies(spark, streamed, monkeypatch, step):
    table, feed = streamed
    before = rows(tables.read(spark, table))

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    show, calls = tables.show, []
    with monkeypatch.context() as patch:
        if step == "write":
            def half(spark, table, df, **kwargs):
                kept(spark, table, df.filter("id < 9"), **kwargs)
                lost()
            kept = tables.overwrite_partitions
            patch.setattr(tables, "overwrite_partitions", half)
        elif step == "switch":
            patch.setattr(tables, "show", lambda *a: show(*a) if not calls and not calls.append(1) else lost())
        else:
            compaction.compact_dates(spark, table, ["id"], "2026-10-27")
            drop = tables.drop_partition
            patch.setattr(tables, "drop_partition",
                          lambda *a: drop(*a) if len(calls) < 3 and not calls.append(1) else lost())
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact_dates(spark, table, ["id"], "2026-10-27")
    assert rows(tables.read(spark, table)) == before
    compaction.compact_dates(spark, table, ["id"], "2026-10-27")
    assert rows(tables.read(spark, table)) == before
    compaction.settle(spark, table)
    assert rows(tables.read(spark, table)) == before and len(parts(spark, table)) == 4


def test_a_hot_key_is_cut(spark, streamed):
    table, feed = streamed
    tables.append(spark, table, tables.read(spark, table))  # appended rows, without a batch, stay
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        compaction.compact_dates(spark, table, [], "2026-10-27")
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert tables.read(spark, table).count() == 200
    made = spark.table(tables.physical(spark, table).sql).filter("stream_batch LIKE 'compact-%'")
    assert len(made.inputFiles()) >= 4
