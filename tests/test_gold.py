"""Publication strategies and refusals."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import Layers, tables
from tierlake.plans.chain import transform_and_publish
from tierlake.plans.gold import publish_gold
from tierlake.plans.silver import write_silver

D1, D2 = date(2026, 10, 21), date(2026, 10, 22)
SCHEMA = ("id int, last_price decimal(5,2), snapshot_date date, quote_at timestamp_ntz, "
          "active boolean, note string")
DATA = [
    (1, Decimal("100.25"), D1, datetime(2026, 10, 21, 4, 0, 0, 123456), True, None),
    (2, Decimal("200.50"), D1, datetime(2026, 10, 21, 4, 1, 0, 123456), False, "two"),
    (3, Decimal("300.75"), D2, datetime(2026, 10, 22, 4, 0, 0, 123456), True, "three"),
    (4, Decimal("400.00"), D2, datetime(2026, 10, 22, 4, 1, 0, 123456), False, "four"),
]


def silver(spark, layers, data=DATA, schema=SCHEMA):
    write_silver(spark, layers, "quotes", spark.createDataFrame(data, schema))


def gold(spark, layers):
    return rows(tables.read(spark, layers.resolve("quotes", "gold")))


@pytest.mark.parametrize("partition_by, date_column", [
    (None, "snapshot_date"), (None, "quote_at"), ("snapshot_date", "SNAPSHOT_DATE"), ("quote_at", "quote_at")])
def test_sequence(spark, layers, partition_by, date_column):
    silver(spark, layers)
    for _ in range(2):
        assert publish_gold(spark, layers, "quotes", "quotes", partition_by=partition_by) == 4
        assert gold(spark, layers) == rows(spark.createDataFrame(DATA, SCHEMA))
    assert publish_gold(spark, layers, "quotes", "quotes", "append") == 4
    assert len(gold(spark, layers)) == 8
    assert publish_gold(spark, layers, "quotes", "quotes", "truncate") == 4
    changed = [(1, Decimal("111.25"), *DATA[0][2:]), *DATA[1:2], *((i, Decimal("1.00"), *r) for i, _, *r in DATA[2:])]
    silver(spark, layers, changed)
    for _ in range(2):
        assert publish_gold(spark, layers, "quotes", "quotes", "delete_and_insert", date_column, "2026-10-21") == 2
        assert gold(spark, layers) == sorted([changed[0], *DATA[1:]])
    table = layers.resolve("quotes", "gold")
    assert tables.read(spark, table).columns == tables.read(spark, layers.resolve("quotes", "silver")).columns
    if partition_by:
        hidden = {"snapshot_date": "snapshot_date", "quote_at": "_day"}[partition_by]
        assert tables.partition_columns(spark, table) == [hidden]


def test_refusals_leave_gold_unchanged(spark, layers):
    silver(spark, layers)
    publish_gold(spark, layers, "quotes", "quotes")
    before = gold(spark, layers)

    def refused(match, *args, **kw):
        with pytest.raises(ValueError, match=match):
            publish_gold(spark, layers, *args, **kw)
        assert gold(spark, layers) == before

    refused("nothing in Silver", "quotes", "quotes", "delete_and_insert", "snapshot_date", "2026-10-23")
    refused("YYYY-MM-DD", "quotes", "quotes", "delete_and_insert", "snapshot_date", "2026-10-21' OR '1'='1")
    refused("give its run_date", "quotes", "quotes", "delete_and_insert", "snapshot_date")
    refused("give the date_column", "quotes", "quotes", "delete_and_insert", None, "2026-10-21")
    refused("DATE or TIMESTAMP", "quotes", "quotes", "delete_and_insert", "note", "2026-10-21")
    refused("the gold layer", "quotes", f"{layers.silver}.quotes")
    refused("the silver layer", f"{layers.gold}.quotes", "quotes")
    refused("not by 'merge'", "quotes", "quotes", "merge")
    silver(spark, layers, [], SCHEMA)
    refused("nothing in Silver", "quotes", "quotes")
    assert publish_gold(spark, layers, "quotes", "quotes", "append") == 0
    assert gold(spark, layers) == before
    silver(spark, layers, [(1, "x", D1)], "id int, note string, snapshot_date date")
    refused("must match", "quotes", "quotes", "append")
    refused("must match", "quotes", "quotes", "delete_and_insert", "snapshot_date", "2026-10-21")
    assert publish_gold(spark, layers, "quotes", "quotes", "replace") == 1


def test_partitioning_is_checked_and_chosen(spark, layers):
    silver(spark, layers)
    for name in ("note", "absent", "a b"):
        with pytest.raises(ValueError):
            publish_gold(spark, layers, "quotes", "quotes", partition_by=name)
    publish_gold(spark, layers, "quotes", "quotes", "delete_and_insert", "snapshot_date", "2026-10-21")
    assert tables.partition_columns(spark, layers.resolve("quotes", "gold")) == ["snapshot_date"]
    spec = {"target_table": "again", "sources": [{"fqn": f"{layers.silver}.quotes"}]}
    transform_and_publish(spark, layers, spec, "again", partition_by="quote_at")
    assert tables.day_of(spark, layers.resolve("again", "gold")) == "quote_at"
    before = spark.catalog.listTables(layers.gold)
    spark.range(3).write.saveAsTable(f"{layers.gold}.lost__0123456789abcdef")
    assert tables.drop_orphans(spark, layers.gold) == ["lost__0123456789abcdef"]
    assert len(spark.catalog.listTables(layers.gold)) == len(before)


@pytest.mark.parametrize("partition_by", [None, "at"])
def test_rows_without_a_date_are_kept(spark, layers, partition_by):
    schema = "id int, at timestamp_ntz"
    silver(spark, layers, [(1, None), (2, datetime(2026, 10, 21, 23)), (3, datetime(2026, 10, 22))], schema)
    publish_gold(spark, layers, "quotes", "quotes", partition_by=partition_by)
    silver(spark, layers, [(9, datetime(2026, 10, 21, 1))], schema)
    assert publish_gold(spark, layers, "quotes", "quotes", "delete_and_insert", "at", "2026-10-21") == 1
    assert [r[0] for r in gold(spark, layers)] == [1, 3, 9]


def test_readers_keep_their_version(spark, layers):
    silver(spark, layers)
    publish_gold(spark, layers, "quotes", "quotes")
    reader = tables.read(spark, layers.resolve("quotes", "gold"))
    silver(spark, layers, DATA[:1])
    publish_gold(spark, layers, "quotes", "quotes")
    assert reader.count() == 4 and len(gold(spark, layers)) == 1


def test_a_failed_replacement_is_not_published(spark, layers):
    table = layers.resolve("t", "gold")
    layers.ensure(spark, "gold")
    tables.replace(spark, table, spark.range(3))
    broken = spark.range(3).select(F.when(F.col("id") < 2, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.replace(spark, table, broken)
    assert tables.read(spark, table).count() == 3
    assert tables.replace(spark, table, spark.range(2)) == 2


def test_chain(spark, layers):
    spark.createDataFrame(DATA, SCHEMA).createOrReplaceTempView("chain_input")
    spec = {"target_table": "doubled", "sources": [{"fqn": "chain_input"}],
            "columns": [{"source_expr": "id"}, {"source_expr": "last_price * 2", "target": "price"}]}
    with pytest.raises(ValueError, match="must be the table"):
        transform_and_publish(spark, layers, spec, "doubled", silver="other")
    with pytest.raises(ValueError, match="give its run_date"):
        transform_and_publish(spark, layers, spec, "doubled", "delete_and_insert")
    assert not tables.exists(spark, layers.resolve("doubled", "silver"))
    with pytest.raises(ValueError, match="Data tests failed"):
        transform_and_publish(spark, layers, spec, "doubled", tests=[
            {"test": "accepted_values", "column": "id", "values": [1]}])
    assert not tables.exists(spark, layers.resolve("doubled", "gold"))
    assert transform_and_publish(spark, layers, spec, "doubled") == (4, 4)


def test_layers_must_differ():
    with pytest.raises(ValueError, match="share a namespace"):
        Layers(gold="de_silver")
    for name in ("a.b.c.d", "other.de_gold.t", "de_silver.t", "t t", ""):
        with pytest.raises(ValueError):
            Layers().resolve(name, "gold")
    assert Layers().resolve("spark_catalog.de_gold.t", "gold").sql == "`de_gold`.`t`"
