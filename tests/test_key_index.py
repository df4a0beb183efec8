"""Merges that read only the partitions which may hold a key."""

import glob

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import key_index, tables

SCHEMA = "id string, part string, v int, day date"


def frame(spark, items):
    data = [(f"k{i}", "a", v, d) for i, v, d in items]
    return spark.createDataFrame(data, SCHEMA.replace("day date", "day string")).withColumn("day", F.col("day").cast("date"))


DAYS = [f"2026-01-{d:02d}" for d in range(1, 9)]


@pytest.fixture
def table(spark, layers):
    layers.ensure(spark, "silver")
    name = layers.resolve("facts", "silver")
    tables.replace(spark, name, frame(spark, [(i, 0, DAYS[i % 8]) for i in range(80)]), ["day"])
    return name


def state(spark, table):
    return rows(tables.read(spark, table), "id", "v", "day")


def break_days(spark, table, days):
    """Make the files of some partitions unreadable."""
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {tables.physical(spark, table).sql}").filter("col_name = 'Location'")
    base = place.first()["data_type"].removeprefix("file:")
    for day in days:
        for path in glob.glob(f"{base}/day={day}/*.parquet"):
            with open(path, "wb") as f:
                f.write(b"broken")


def expected(changes):
    known = {f"k{i}": (0, DAYS[i % 8]) for i in range(80)}
    known.update({f"k{i}": (v, d) for i, v, d in changes})
    return sorted((k, v, d) for k, (v, d) in known.items())


def test_merge_leaves_other_partitions_unread(spark, table):
    first = [(i, 1, DAYS[0]) for i in (0, 8, 3)]
    tables.merge_by_key(spark, table, frame(spark, first), ["id"])
    found = [(k, v, str(d)) for k, v, d in state(spark, table)]
    assert sorted(found) == expected(first)
    # The index stands now: a merge of keys of days 1 and 2 opens no file of the others.
    break_days(spark, table, DAYS[4:])
    second = [(1, 2, DAYS[1]), (9, 2, DAYS[2]), (500, 2, DAYS[1])]
    assert tables.merge_by_key(spark, table, frame(spark, second), ["id"]) > 0
    good = tables.read(spark, table).filter(F.col("day") < F.lit(DAYS[4]).cast("date"))
    assert {r.id: r.v for r in good.collect()}["k500"] == 2
    # A key that the last merge brought is known to the index.
    third = frame(spark, [(500, 3, DAYS[3])])
    tables.merge_by_key(spark, table, third, ["id"])
    tables.compact_index(spark, table)
    plan = tables.read(spark, table).filter(tables.holding(spark, table, third, ["id"]))._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "2026-01-04" in plan and "2026-01-05" not in plan


@pytest.mark.parametrize("slots", [1, 40, key_index.SLOTS])
def test_chance_hits_change_nothing(spark, table, slots):
    changes = [(5, 1, DAYS[0]), (13, 1, DAYS[5]), (99, 1, DAYS[7]), (100, 1, None)]
    for _ in range(2):
        tables.merge_by_key(spark, table, frame(spark, changes), ["id"], slots=slots)
    found = sorted((k, v, d and str(d)) for k, v, d in state(spark, table))
    assert found == sorted(expected(changes), key=lambda r: r[0])


def test_other_writes_take_the_index_out_of_use(spark, table):
    tables.merge_by_key(spark, table, frame(spark, [(0, 1, DAYS[0])]), ["id"])
    tables.append(spark, table, frame(spark, [(200, 5, DAYS[6])]))
    tables.merge_by_key(spark, table, frame(spark, [(200, 6, DAYS[1])]), ["id"])
    assert [(v, str(d)) for k, v, d in state(spark, table) if k == "k200"] == [(6, DAYS[1])]
    tables.overwrite_partitions(spark, table, frame(spark, [(300, 5, DAYS[6])]))
    tables.merge_by_key(spark, table, frame(spark, [(300, 7, DAYS[2])]), ["id"])
    assert [(v, str(d)) for k, v, d in state(spark, table) if k == "k300"] == [(7, DAYS[2])]


def test_whole_number_keys_and_other_types(spark, layers):
    layers.ensure(spark, "silver")
    name = layers.resolve("numbers", "silver")
    base = spark.range(-50, 50).select("id", (F.col("id") % 5).cast("int").alias("p"), F.lit(0).alias("v"))
    tables.replace(spark, name, base, ["p"])
    for kind in ("int", "bigint", "smallint"):
        source = spark.range(-5, 60, 13).select(F.col("id").cast(kind).alias("id"), F.lit(1).alias("p"), F.lit(1).alias("v"))
        tables.merge_by_key(spark, name, source, ["id"])
    found = {r.id: (r.p, r.v) for r in tables.read(spark, name).collect()}
    assert len(found) == tables.read(spark, name).count() == 100
    assert all(found[i] == (1, 1) for i in range(-5, 60, 13)) and found[-50][1] == 0
    # Keys with missing values match nothing and are added.
    tables.merge_by_key(spark, name, spark.createDataFrame([(None, 1, 2)], "id long, p int, v int"), ["id"])
    assert tables.read(spark, name).count() == 101
