"""Tests of what a batch brought to a table, without its history."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_key_index import DAYS, break_days, frame
from tierlake import tables
from tierlake.operators.quality import run_tests
from tierlake.plans.batch_tests import run_batch_tests
from tierlake.plans.silver import run_silver

TESTS = [
    {"test": "not_null", "column": "v"}, {"test": "unique", "column": "id"},
    {"test": "unique_combination", "columns": ["id", "v"]}, {"test": "accepted_values", "column": "part", "values": ["a"]},
]


@pytest.fixture
def table(spark, layers):
    layers.ensure(spark, "silver")
    name = layers.resolve("facts", "silver")
    tables.replace(spark, name, frame(spark, [(i, 0, DAYS[i % 8]) for i in range(80)]), ["day"])
    return name


def both(spark, table, batch, **more):
    """The report on the batch, which must be that on the whole table."""
    report = rows(run_batch_tests(spark, table, batch, TESTS, **more))
    assert report == rows(run_tests(tables.read(spark, table), TESTS))
    return {(test, column): n for test, column, n in report}


@pytest.mark.parametrize("slots", [1, 64, 1 << 20])
def test_report_is_that_of_the_whole_table(spark, table, slots):
    clean = frame(spark, [(i, 1, DAYS[i % 3]) for i in range(80, 90)])
    tables.append(spark, table, clean)
    assert set(both(spark, table, clean, slots=slots).values()) == {0}
    # Repeats: in the batch alone, with one old row, with a row of the batch before; a missing value; a null key twice.
    batch = frame(spark, [(100, 1, DAYS[0]), (100, 2, DAYS[1]), (7, 0, DAYS[2]), (8, 5, DAYS[7]), (85, 1, DAYS[5]), (101, None, None)])
    empty = batch.limit(1).withColumn("id", F.lit(None).cast("string"))
    batch = batch.unionByName(empty).unionByName(empty)
    tables.append(spark, table, batch, keep_index=True)
    found = both(spark, table, batch)
    assert found == {("not_null", "v"): 1, ("unique", "id"): 4, ("unique_combination", "id,v"): 3, ("accepted_values", "part"): 0}


def test_nulls_of_earlier_batches_count(spark, table):
    empty = frame(spark, [(0, 3, DAYS[0])]).withColumn("id", F.lit(None).cast("string"))
    tables.append(spark, table, empty)
    assert both(spark, table, empty)["unique_combination", "id,v"] == 0
    again = empty.withColumn("day", F.lit(DAYS[4]).cast("date"))
    tables.append(spark, table, again, keep_index=True)
    assert both(spark, table, again) | {} == {
        ("not_null", "v"): 0, ("unique", "id"): 0, ("unique_combination", "id,v"): 1, ("accepted_values", "part"): 0}


def test_other_partitions_are_not_opened(spark, table):
    nothing = frame(spark, [(0, 0, DAYS[0])]).limit(0)
    assert set(both(spark, table, nothing).values()) == {0}
    batch = frame(spark, [(1, 9, DAYS[0]), (300, 0, DAYS[2])])
    tables.append(spark, table, batch, keep_index=True)
    expected = rows(run_tests(tables.read(spark, table), TESTS))
    break_days(spark, table, DAYS[3:])
    assert rows(run_batch_tests(spark, table, batch, TESTS)) == expected
    with pytest.raises(Exception):
        run_tests(tables.read(spark, table), TESTS).collect()
    # Compaction and merges keep both indexes.
    tables.compact_index(spark, table)
    tables.merge_by_key(spark, table, frame(spark, [(300, 1, DAYS[1])]), ["id"])
    later = frame(spark, [(300, 1, DAYS[2])])
    tables.append(spark, table, later, keep_index=True)
    report = {(test, column): n for test, column, n in rows(run_batch_tests(spark, table, later, TESTS))}
    assert report["unique", "id"] == report["unique_combination", "id,v"] == 1


def test_tables_without_partitions_and_no_tests(spark, layers):
    layers.ensure(spark, "silver")
    name = layers.resolve("flat", "silver")
    tables.replace(spark, name, frame(spark, [(1, 0, DAYS[0])]))
    batch = frame(spark, [(1, 0, DAYS[1])])
    tables.append(spark, name, batch, keep_index=True)
    assert both(spark, name, batch)["unique", "id"] == 1
    with pytest.raises(ValueError, match="No tests"):
        run_batch_tests(spark, name, batch, [])


@pytest.mark.parametrize("strategy", ["append", "merge"])
def test_a_model_tests_what_it_wrote(spark, layers, strategy):
    def run(items):
        frame(spark, items).withColumnRenamed("day", "snapshot_date").createOrReplaceTempView("batch_in")
        spec = {"sources": [{"fqn": "batch_in", "alias": "b"}], "target_table": "model", "strategy": strategy, "keys": ["id"],
                "columns": [{"source_expr": f"b.{c}", "target": c, "cast": ""} for c in ("id", "part", "v", "snapshot_date")]}
        return run_silver(spark, layers, spec, tests=TESTS, whole=False)

    assert run([(i, 0, DAYS[i % 4]) for i in range(20)]) == 20
    assert run([(30, 0, DAYS[1])]) >= 1
    if strategy == "append":
        with pytest.raises(ValueError, match=r"unique\(id\): 1, unique_combination\(id,v\): 1"):
            run([(3, 0, DAYS[2]), (31, 0, DAYS[2])])
    else:
        run([(3, 1, DAYS[2]), (31, 0, DAYS[2])])
        found = tables.read(spark, layers.resolve("model", "silver"))
        assert found.count() == 22 and [r.v for r in found.filter("id = 'k3'").collect()] == [1]
