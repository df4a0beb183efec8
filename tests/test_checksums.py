"""Reconciliation by checksums, and writes that are verified."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.operators import checksums
from tierlake.operators.checksums import differing_rows

SCHEMA = "k string, n int, v double, t timestamp"


@pytest.fixture
def left(spark):
    data = [(f"k{i % 40}" if i % 11 else None, i % 3, float(i) if i % 5 else None) for i in range(200)]
    return spark.createDataFrame(data, "k string, n int, v double").withColumn("t", F.lit("2026-01-01").cast("timestamp"))


def test_order_and_columns_do_not_matter(left):
    right = left.select("v", "t", "n", "k").repartition(7).sortWithinPartitions("v")
    assert differing_rows(left, right, ["k"]).count() == 0
    assert differing_rows(left.limit(0), right.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("buckets", [1, 5, 1024])
def test_what_differs(spark, left, buckets):
    rest = left.filter("NOT coalesce(n = 0 AND k = 'k1' OR k = 'k3' AND v = 83.0, false)")
    more = left.filter("k = 'k2' AND v = 2.0")
    swapped = left.filter("k = 'k3' AND v = 83.0").withColumn("v", F.lit(None).cast("double"))
    fresh = spark.createDataFrame([("new", 1, 1.0), (None, 9, 9.0)], "k string, n int, v double").withColumn("t", F.col("n").cast("timestamp"))
    right = rest.unionByName(more).unionByName(swapped).unionByName(fresh)
    lost = left.filter("n = 0 AND k = 'k1'").count()
    assert lost > 0
    assert rows(differing_rows(left, right, ["k"], buckets)) == rows(spark.createDataFrame(
        [("k1", "lost", lost, 0), ("k2", "doubled", 0, 1), ("k3", "changed", 1, 1), ("new", "added", 0, 1), (None, "added", 0, 1)],
        "k string, status string, missing long, extra long"))


def test_nulls_and_values_do_not_trade_places(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "x", None)], "k int, a string, b string")
    b = spark.createDataFrame([(1, "x", None), (2, None, "x")], "k int, a string, b string")
    assert {r.k: r.status for r in differing_rows(a, b, ["k"]).collect()} == {1: "changed", 2: "changed"}
    with pytest.raises(ValueError):
        differing_rows(a, b.withColumn("k", F.col("k").cast("long")), ["k"])
    with pytest.raises(ValueError):
        differing_rows(a, b, [])


def test_only_differing_buckets_are_read_again(left):
    right = left.filter("NOT (k <=> 'k1')")
    plan = differing_rows(left, right, ["k"], 64)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("pmod") >= 2 and "Join" not in plan


@pytest.mark.parametrize("how", ["rows", "values"])
def test_verified_writes(spark, layers, left, how):
    layers.ensure(spark, "silver")
    name = layers.resolve("facts", "silver")
    tables.replace(spark, name, left, ["n"], verify=how)
    tables.append(spark, name, left, verify=True)
    # A narrower type is stored as the table's; its checksum is that of what is stored.
    tables.overwrite_partitions(spark, name, left.filter("n = 1").withColumn("n", F.col("n").cast("smallint")), verify=how)
    tables.merge_by_key(spark, name, left.filter("k = 'k1'").limit(1), ["k"], verify=how)
    assert tables.read(spark, name).filter("n = 1").count() > 0
    with pytest.raises(ValueError):
        tables.replace(spark, name, left, verify="something")


def test_a_bad_version_is_not_published(spark, layers, left, monkeypatch):
    layers.ensure(spark, "silver")
    name = layers.resolve("facts", "silver")
    tables.replace(spark, name, left, ["n"])
    before = tables.physical(spark, name)

    def short(found, wanted, what):
        return checked(found.filter("n > 0"), wanted, what)

    checked = tables._verify
    monkeypatch.setattr(tables, "_verify", short)
    for how in ("rows", "values"):
        with pytest.raises(tables.Mismatch):
            tables.replace(spark, name, left, ["n"], verify=how)
    assert tables.physical(spark, name) == before and tables.read(spark, name).count() == 200
    assert len(tables.drop_orphans(spark, name.database)) == 0
    assert checksums.BUCKETS > 1
