"""Every registered query against DuckDB on the small tables, and what plans must not hold."""

import glob
import os

import pytest

import __spark_entry__ as driver

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(set(driver.queries()) & set(driver.oracle_sql())))
def test_query(spark, duck, name):
    frame = driver.queries()[name](spark, TABLES)
    columns = sorted(frame.columns)
    found = ordered(tuple(row) for row in frame.select(*(f"`{c}`" for c in columns)).collect())
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert found == ordered(tuple(row[i] for i in places) for row in result.fetchall())


@pytest.mark.parametrize("name", ["bronze_delta_late", "silver_mapper", "silver_full_then_left", "payload_flatten",
                                  "live_packets", "pii_hash_text", "silver_day_gap", "run_attempts"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    frame = driver.queries()[name](spark, TABLES)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_delta_shuffles_the_snapshot_once(spark):
    from pyspark.sql import functions as F

    from tierlake.operators.snapshots import merge_snapshots

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.read.parquet(f"{TABLES}/events.parquet")
        batch = events.filter("event_id % 3 = 0").withColumn("value", F.col("value") + 1)
        merged = merge_snapshots(events, batch, ["event_id"], "ts", previous_unique=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3 and plan.count("FileScan") == 2
        # The snapshot once, the batch for its ranking and for the join.
        assert plan.count("Window [") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns[:3] == ["event_id", "ts", "user_id"] and frame.count() > 0
