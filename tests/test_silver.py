"""Specifications, strategies, merges, models and data tests."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.operators.joins import missing_keys, require_complete
from tierlake.operators.quality import duplicate_names, reconcile, require_passing, run_tests
from tierlake.plans.silver import (
    build_silver, explain_silver, live_ticks_model, market_snapshot_model, materialise, run_silver,
    state_day_gap_model, write_silver)
from tierlake.sources.market import RECORD

D1, D2 = date(2026, 10, 21), date(2026, 10, 22)


@pytest.fixture
def views(spark):
    spark.createDataFrame([("1333", 100.5, D1), ("11536", 200.5, D1), ("7", 1.0, D2)],
                          "security_id string, last_price double, snapshot_date date").createOrReplaceTempView("quotes")
    spark.createDataFrame([("1333", "bank"), ("99", "none"), (None, "null")],
                          "id string, name string").createOrReplaceTempView("names")


def spec(**changes):
    return {
        "target_table": "doubled", "strategy": "overwrite",
        "sources": [{"fqn": "quotes", "alias": "src"}],
        "columns": [{"source_expr": "src.security_id", "target": "security_id"},
                    {"source_expr": "src.last_price * 2", "target": "last_price"},
                    {"source_expr": "src.snapshot_date", "target": "snapshot_date"}],
    } | changes


def test_projection(spark, layers, views):
    assert run_silver(spark, layers, spec()) == 3
    found = tables.read(spark, layers.resolve("doubled", "silver"))
    assert found.columns == ["security_id", "last_price", "snapshot_date"]
    assert rows(found, "security_id", "last_price") == [("11536", 401.0), ("1333", 201.0), ("7", 2.0)]


def test_defaults_and_casts(spark, views):
    frame = build_silver(spark, {"sources": [{"fqn": "quotes"}], "columns": [
        {"source_expr": "src.security_id", "cast": "INTEGER"}, {"source_expr": "last_price", "cast": "varchar"},
        {"source_expr": " "}]})
    assert frame.dtypes == [("security_id", "int"), ("last_price", "string")]
    assert build_silver(spark, {"sources": [{"fqn": "quotes"}]}).columns == ["security_id", "last_price", "snapshot_date"]


def test_second_source_has_a_default_alias(spark, views):
    frame = build_silver(spark, {
        "sources": [{"fqn": "quotes"}, {"fqn": "names", "join_conds": [
            {"lh": "src.security_id", "rh": "src2.id"}, {"lh": "", "rh": "x"}]}],
        "columns": [{"source_expr": "src2.name"}]})
    assert rows(frame) == [("bank",)]


@pytest.mark.parametrize("item, kept", [
    ({"col": "last_price", "op": ">", "val": "100"}, 2), ({"col": "last_price", "op": "<=", "val": "-5.5"}, 0),
    ({"col": "security_id", "op": "like", "val": "1%"}, 2), ({"col": "security_id", "val": "'7'"}, 1),
    ({"col": "security_id", "op": "!=", "val": "it's"}, 3), ({"col": "security_id", "op": "is  null"}, 0),
    ({"col": "security_id", "op": "IS NOT NULL", "val": "x"}, 3), ({"col": "security_id", "op": "=", "val": " "}, 3),
    ({"col": "", "op": "=", "val": "1"}, 3),
])
def test_filters(spark, views, item, kept):
    assert build_silver(spark, {"sources": [{"fqn": "quotes"}], "filters": [item]}).count() == kept


def test_snapshot_filter_follows_the_joins(spark, views):
    sources = [{"fqn": "names", "alias": "n"},
               {"fqn": "quotes", "alias": "q", "join_type": "LEFT JOIN", "snapshot_date": True,
                "join_conds": [{"lh": "n.id", "rh": "q.security_id"}]}]
    columns = [{"source_expr": "n.name"}]
    assert rows(build_silver(spark, {"sources": sources, "columns": columns}, "2026-10-21")) == [("bank",)]


def test_refused_specifications(spark, layers, views):
    join = {"fqn": "names", "alias": "n"}
    for sources, message in (
            ([], "without sources"), ([{"fqn": "quotes"}, join], "both sides"),
            ([{"fqn": "quotes"}, join | {"join_type": "CROSS JOIN"}], "pairs every row"),
            ([{"fqn": "quotes"}, join | {"join_type": "NATURAL JOIN"}], "cannot be joined"),
            ([{"fqn": "quotes; drop"}], "cannot be used")):
        with pytest.raises(ValueError, match=message):
            build_silver(spark, {"sources": sources})
    with pytest.raises(ValueError, match="operator"):
        build_silver(spark, spec(filters=[{"col": "a", "op": "OR 1=1 --", "val": "1"}]))
    with pytest.raises(ValueError, match="strategy"):
        run_silver(spark, layers, spec(strategy="upsert"))
    with pytest.raises(ValueError, match="cannot be used"):
        run_silver(spark, layers, spec(target_table="a.b"))


def test_strategies(spark, layers, views):
    table = layers.resolve("doubled", "silver")
    run_silver(spark, layers, spec())
    run_silver(spark, layers, spec(strategy="append"))
    assert tables.read(spark, table).count() == 6
    one_day = spec(strategy="insert_overwrite", sources=[{"fqn": "quotes", "alias": "src", "snapshot_date": True}])
    run_silver(spark, layers, one_day, "2026-10-21")
    assert rows(tables.read(spark, table).groupBy("snapshot_date").count()) == [(D1, 2), (D2, 2)]
    run_silver(spark, layers, one_day | {"filters": [{"col": "src.last_price", "op": ">", "val": "900"}]}, "2026-10-21")
    assert rows(tables.read(spark, table).groupBy("snapshot_date").count()) == [(D2, 2)]


def test_insert_overwrite_keeps_rows_without_a_date(spark, layers):
    schema = "id int, snapshot_date date"
    write_silver(spark, layers, "t", spark.createDataFrame([(1, None), (2, D1), (3, D2)], schema))
    write_silver(spark, layers, "t", spark.createDataFrame([(4, None), (5, D2)], schema), "insert_overwrite")
    assert rows(tables.read(spark, layers.resolve("t", "silver"))) == [(1, None), (2, D1), (4, None), (5, D2)]


def test_merge_moves_rows_between_partitions(spark, layers):
    schema, table = "id string, v int, snapshot_date date", layers.resolve("t", "silver")
    start = spark.createDataFrame([("a", 1, D1), ("b", 1, D2), (None, 1, D2)], schema)
    write_silver(spark, layers, "t", start, "merge", keys=["id"])
    change = spark.createDataFrame([("a", 2, D2), ("c", 2, D2)], schema)
    expected = [(None, 1, D2), ("a", 2, D2), ("b", 1, D2), ("c", 2, D2)]
    for atomic in (False, False, True):
        tables.merge_by_key(spark, table, change, ["id"], ["snapshot_date"], atomic=atomic)
        assert rows(tables.read(spark, table)) == expected
    with pytest.raises(ValueError, match="several rows"):
        write_silver(spark, layers, "t", change.union(change), "merge", keys=["id"])
    with pytest.raises(ValueError, match="columns do not match"):
        write_silver(spark, layers, "t", change.withColumn("w", F.lit(1)), "merge", keys=["id"])
    assert rows(tables.read(spark, table)) == expected


def test_full_join_over_a_hot_key(spark):
    spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 9)], "k int, l int").createOrReplaceTempView("l")
    spark.createDataFrame([(1, 1), (3, 3), (None, 8)], "k int, r int").createOrReplaceTempView("r")
    got = build_silver(spark, {"sources": [{"fqn": "l", "alias": "l"}, {
        "fqn": "r", "alias": "r", "join_type": "full join", "join_conds": [{"lh": "r.k", "rh": "l.k"}]}],
        "columns": [{"source_expr": "l.l"}, {"source_expr": "r.r"}]})
    want = spark.sql("SELECT l.l, r.r FROM l FULL JOIN r ON l.k = r.k")
    assert rows(got) == rows(want)


def test_data_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 2), (None, 3)], "k string, n int")
    report = run_tests(df, [
        {"test": "not_null", "column": "n"}, {"test": "accepted_values", "column": "k", "values": ["a"]},
        {"test": "unique", "column": "k"}, {"test": "unique_combination", "columns": ["k", "n"]}])
    assert rows(report) == [("accepted_values", "k", 1), ("not_null", "n", 1), ("unique", "k", 1),
                            ("unique_combination", "k,n", 1)]
    with pytest.raises(ValueError, match=r"unique\(k\): 1"):
        require_passing(report)
    require_passing(run_tests(df.filter("n = 2"), [{"test": "unique", "column": "n"}]))
    with pytest.raises(ValueError, match="Unknown test"):
        run_tests(df, [{"test": "odd", "column": "n"}])
    assert rows(duplicate_names(df, "k")) == [("a", 2)]


def test_completeness(spark):
    asked = spark.createDataFrame([("A", i) for i in range(15)], "s string, i int")
    require_complete(asked, asked.union(asked), ["s", "i"])
    with pytest.raises(ValueError, match=r"^12 requested.*: A:0, A:1, A:2, A:3, A:4, A:5, A:6, A:7, A:8, A:9$"):
        require_complete(asked, asked.filter("i > 11"), ["s", "i"])
    assert rows(missing_keys(asked, asked.filter("i <> 4"), ["s", "i"])) == [("A", 4)]


def test_reconcile(spark):
    left = spark.createDataFrame([(1, 0.1), (2, 0.2), (2, None)], "k int, v double")
    report = {r["measure"]: (float(r["left_value"]), float(r["right_value"]), r["matches"])
              for r in reconcile(left, left.dropna(), ["k"], ["v"]).collect()}
    assert report == {"rows": (3, 2, False), "sum_v": (0.3, 0.3, True), "nulls_v": (1, 0, False), "keys": (2, 2, True)}


def test_state_day_gap_model(spark):
    df = spark.createDataFrame([(1, "2026-01-01", D1), (1, "2026-01-04", D1), (2, "2026-01-01", D1)],
                               "state_fips int, date string, snapshot_date date")
    assert rows(state_day_gap_model(df)) == [(1, None), (1, 3), (2, None)]


def market_rows(spark, *values):
    """Bronze rows: (event_id, segment, id, price, date)."""
    df = spark.createDataFrame(values, "event_id string, exchange_segment string, security_id string, "
                                       "last_price double, snapshot_date date")
    rest = {name: F.lit(None).cast(kind) for name, kind in RECORD.items() if name not in df.columns}
    return df.withColumns(rest | {
        "received_at": F.col("snapshot_date").cast("timestamp"), "trading_date": F.col("snapshot_date")})


def put_bronze(spark, layers, name, df):
    layers.ensure(spark, "bronze")
    tables.replace(spark, layers.resolve(name, "bronze"), df, ["snapshot_date"])


def test_market_models(spark, layers):
    put_bronze(spark, layers, "quotes", market_rows(
        spark, ("e1", "NSE_EQ", "1", 1.0, D1), ("e2", "NSE_EQ", "2", 2.0, D1), ("e3", "NSE_EQ", "1", 3.0, D2)))
    for name in ("2026-10-21", "2026-10-22", "2026-10-21"):
        market_snapshot_model(spark, layers, "quotes", name)
    silver = tables.read(spark, layers.resolve("nse_market_snapshot", "silver"))
    assert rows(silver, "security_id", "last_price", "snapshot_date") == [("1", 1.0, D1), ("1", 3.0, D2), ("2", 2.0, D1)]
    # The event of the first day is replayed on the second one.
    put_bronze(spark, layers, "ticks", market_rows(
        spark, ("e1", "NSE_EQ", "1", 1.0, D1), ("e2", "IDX_I", "2", 2.0, D1), ("e1", "NSE_EQ", "1", 5.0, D2)))
    for name in ("2026-10-21", "2026-10-22"):
        live_ticks_model(spark, layers, "ticks", name)
    ticks = tables.read(spark, layers.resolve("nse_live_ticks", "silver"))
    assert len(ticks.columns) == 29
    assert rows(ticks, "event_id", "last_price", "snapshot_date") == [("e1", 5.0, D2), ("e2", 2.0, D1)]
    put_bronze(spark, layers, "ticks", market_rows(spark, ("e9", "BSE", "1", 1.0, D1)))
    with pytest.raises(ValueError, match="accepted_values"):
        live_ticks_model(spark, layers, "ticks", "2026-10-21")


def test_explain_and_views(spark, layers, views):
    put_bronze(spark, layers, "quotes", spark.table("quotes"))
    plan = explain_silver(spark, spec(sources=[
        {"fqn": f"{layers.bronze}.quotes", "alias": "src", "snapshot_date": True}]), "2026-10-21")
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema" in plan
    materialise(spark, layers, "staged", spark.table("quotes"), "view")
    materialise(spark, layers, "mart", spark.table("staged"))
    assert tables.read(spark, layers.resolve("mart", "silver")).count() == 3


def test_merge_of_a_joined_source(spark, layers, views):
    joined = spec(strategy="merge", keys=["security_id"], sources=[
        {"fqn": "quotes", "alias": "src"},
        {"fqn": "names", "alias": "n", "join_conds": [{"lh": "n.id", "rh": "src.security_id"}]}])
    for _ in range(2):
        run_silver(spark, layers, joined)
    assert rows(tables.read(spark, layers.resolve("doubled", "silver")), "security_id", "last_price") == [("1333", 201.0)]
    assert [t.name for t in spark.catalog.listTables(layers.silver) if t.tableType == "MANAGED"] == [
        tables.physical(spark, layers.resolve("doubled", "silver")).table]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_merges(spark, layers, seed):
    """Rows wander between dates, and to and from no date, as in a dictionary."""
    import random

    rng, schema = random.Random(seed), "id int, v int, snapshot_date date"
    dates, expected, table = [None, D1, D2, date(2026, 10, 23)], {}, layers.resolve("t", "silver")
    for step in range(5):
        change = {i: (i, step, rng.choice(dates)) for i in rng.sample(range(12), 6 if step < 2 else 3)}
        expected |= change
        write_silver(spark, layers, "t", spark.createDataFrame(list(change.values()), schema), "merge", keys=["id"])
        found = [tuple(r) for r in tables.read(spark, table).collect()]
        assert sorted(found, key=str) == sorted(expected.values(), key=str)
    listed = spark.sql(f"SHOW PARTITIONS {tables.physical(spark, table).sql}").count()
    assert listed == len({row[2] for row in expected.values()})
