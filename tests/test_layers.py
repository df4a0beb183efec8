"""Lake and Bronze: the two-day scenario, replays, refusals."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake import tables
from tierlake.operators.snapshots import latest_per_key, merge_snapshots
from tierlake.plans.bronze import bronze_delta, bronze_full, latest_snapshot, read_snapshot, rebuild_from
from tierlake.plans.chain import ingest_and_promote
from tierlake.plans.lake import ingest

DAY1, DAY2 = "2026-10-21", "2026-10-22"
QUOTES = {
    DAY1: [("NSE_EQ", "1333", "100.0", "2026-10-21 04:00"), ("NSE_EQ", "1333", "101.0", "2026-10-21 04:01"),
           ("IDX_I", "13", "25000.0", "2026-10-21 04:00")],
    DAY2: [("NSE_EQ", "1333", "102.0", "2026-10-22 04:00"), ("IDX_I", "13", "24000.0", "2026-10-20 04:00"),
           ("NSE_EQ", "11536", "150.0", "2026-10-22 04:00")],
}
SCHEMA = "exchange_segment string, security_id string, last_price string, received_at string"


@pytest.fixture
def quotes(sheet):
    return sheet([("exchange_segment", "string"), ("security_id", "string"), ("last_price", "double"),
                  ("received_at", "timestamp")], ["exchange_segment", "security_id"], "received_at")


def day(spark, name):
    return spark.createDataFrame(QUOTES[name], SCHEMA)


def state(spark, layers, name, snapshot):
    return {r["security_id"]: r["last_price"]
            for r in read_snapshot(spark, layers.resolve(name, "bronze"), snapshot).collect()}


def test_two_day_scenario(spark, layers, quotes):
    lake = layers.resolve("quotes", "lake")
    assert ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1) == 3
    assert ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1) == 3
    assert tables.read(spark, lake).count() == 3
    assert bronze_full(spark, layers, "quotes", DAY1, quotes) == 2
    assert state(spark, layers, "quotes", DAY1) == {"1333": 101.0, "13": 25000.0}
    ingest(spark, layers, "quotes", day(spark, DAY2), quotes, DAY2)
    assert tables.read(spark, lake).count() == 6
    for _ in range(2):
        assert bronze_delta(spark, layers, "quotes", DAY2, quotes) == 3
        assert tables.read(spark, layers.resolve("quotes", "bronze")).count() == 5
        assert state(spark, layers, "quotes", DAY2) == {"1333": 102.0, "13": 25000.0, "11536": 150.0}
    before = rows(tables.read(spark, layers.resolve("quotes", "bronze")))
    for job in (bronze_full, bronze_delta):
        with pytest.raises(ValueError, match="No Lake rows"):
            job(spark, layers, "quotes", "2026-10-23", quotes)
    for mode in ("append", "overwrite", "replace"):
        with pytest.raises(ValueError, match="no rows for the Lake"):
            ingest(spark, layers, "quotes", day(spark, DAY1).limit(0), quotes, "2026-10-23", mode)
    assert rows(tables.read(spark, layers.resolve("quotes", "bronze"))) == before
    assert tables.read(spark, lake).count() == 6


def test_replayed_appends_collapse(spark, layers, quotes):
    for _ in range(2):
        ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1, "append")
    assert tables.read(spark, layers.resolve("quotes", "lake")).count() == 6
    assert bronze_full(spark, layers, "quotes", DAY1, quotes) == 2


def test_delta_without_history_is_a_full_run(spark, layers, quotes):
    for date in (DAY2, DAY1):
        ingest(spark, layers, "quotes", day(spark, date), quotes, date)
        bronze_delta(spark, layers, "quotes", date, quotes)
    assert state(spark, layers, "quotes", DAY1) == {"1333": 101.0, "13": 25000.0}
    assert state(spark, layers, "quotes", DAY2) == {"1333": 102.0, "13": 24000.0, "11536": 150.0}
    assert [str(d) for d in rebuild_from(spark, layers, "quotes", DAY1, quotes)] == [DAY1, DAY2]
    assert state(spark, layers, "quotes", DAY2) == {"1333": 102.0, "13": 25000.0, "11536": 150.0}


def test_latest_snapshot(spark, layers, quotes):
    table = layers.resolve("quotes", "bronze")
    assert latest_snapshot(spark, table, DAY2) is None
    ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1)
    bronze_full(spark, layers, "quotes", DAY1, quotes)
    assert str(latest_snapshot(spark, table, DAY2)) == DAY1
    assert latest_snapshot(spark, table, DAY1) is None


def test_delta_after_a_change_of_keys(spark, layers, sheet, quotes):
    """The earlier snapshot has several rows for the new key; they are all ranked."""
    no_keys = sheet([(f.name, f.datatype) for f in quotes.fields], (), "received_at")
    ingest(spark, layers, "quotes", day(spark, DAY1), no_keys, DAY1)
    assert bronze_full(spark, layers, "quotes", DAY1, no_keys) == 3
    ingest(spark, layers, "quotes", day(spark, DAY2).limit(0).union(day(spark, DAY2).filter("security_id = '11536'")),
           quotes, DAY2)
    assert bronze_delta(spark, layers, "quotes", DAY2, quotes) == 3
    assert state(spark, layers, "quotes", DAY2) == {"1333": 101.0, "13": 25000.0, "11536": 150.0}


def test_column_drift_fails(spark, layers, sheet, quotes):
    ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1)
    bronze_full(spark, layers, "quotes", DAY1, quotes)
    wider = sheet([*((f.name, f.datatype) for f in quotes.fields), ("extra", "string")],
                  ["exchange_segment", "security_id"], "received_at")
    data = day(spark, DAY2).withColumn("extra", F.lit("x"))
    with pytest.raises(ValueError, match="do not match"):
        ingest(spark, layers, "quotes", data, wider, DAY2)
    ingest(spark, layers, "quotes", data, wider, DAY2, "replace")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|cannot be resolved"):
        bronze_delta(spark, layers, "quotes", DAY2, wider)


def test_chain_and_names(spark, layers, quotes):
    assert ingest_and_promote(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1) == (3, 2)
    assert ingest_and_promote(spark, layers, "quotes", day(spark, DAY2), quotes, DAY2) == (3, 3)
    assert ingest_and_promote(spark, layers, "quotes", day(spark, DAY2), quotes, DAY2, "replace") == (3, 3)
    assert state(spark, layers, "quotes", DAY2)["13"] == 24000.0
    for bad in ("Quotes", "a b", "x;drop"):
        with pytest.raises(ValueError, match="cannot be used"):
            ingest(spark, layers, bad, day(spark, DAY1), quotes, DAY1)
    for bad in ("2026-1-1", "21/10/2026", "x' OR '1"):
        with pytest.raises(ValueError, match="YYYY-MM-DD"):
            bronze_full(spark, layers, "quotes", bad, quotes)


def test_extra_partitions_keep_their_text(spark, layers, quotes):
    for site in ("007", "7"):
        ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1, extra_partitions={"site": site})
    found = tables.read(spark, layers.resolve("quotes", "lake"))
    assert sorted(r[0] for r in found.select("site").distinct().collect()) == ["007", "7"]
    with pytest.raises(ValueError, match="cannot be used"):
        ingest(spark, layers, "quotes", day(spark, DAY1), quotes, DAY1, extra_partitions={"a-b": "1"})


def test_both_merge_paths_agree_with_a_plain_loop(spark):
    """Null keys, null times, ties and late rows, against a dictionary."""
    import random

    rng = random.Random(5)
    keys = [None, "a", "b", "c", "d", "e", "f"]
    times = [None, 1, 2, 3]
    previous = {k: (k, rng.choice(times), f"p{i}") for i, k in enumerate(keys[:5])}
    batch = [(rng.choice(keys), rng.choice(times), f"n{i}") for i in range(30)]

    def rank(row, old):
        # Larger time first, nulls last; then new before old; then the larger value.
        return (row[1] is not None, row[1] or 0, not old, row[2])

    best = {}
    for row in batch:
        if row[0] not in best or rank(row, False) > rank(best[row[0]][0], False):
            best[row[0]] = (row, False)
    for key, row in previous.items():
        if key not in best or rank(row, True) > rank(*best[key]):
            best[key] = (row, True)
    expected = sorted((row for row, _ in best.values()), key=str)
    schema = "k string, t int, v string"
    old = spark.createDataFrame(list(previous.values()), schema)
    new = spark.createDataFrame(batch, schema)
    for unique in (False, True):
        merged = merge_snapshots(old, new, ["k"], "t", previous_unique=unique)
        assert sorted((tuple(r) for r in merged.collect()), key=str) == expected
    assert merge_snapshots(old, old, []).count() == len(previous)
    assert sorted(tuple(r) for r in merge_snapshots(old, old.withColumn("v", F.lit("x")), ["k"]).select("v").collect()) \
        == [("x",)] * len(previous)


def test_latest_is_limited_before_the_shuffle(spark):
    data = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(data, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial  # printed from the top: the limit is below the exchange


@pytest.mark.parametrize("timed,keyed", [(True, True), (False, True), (True, False)])
def test_rebuild_in_one_pass_equals_the_chain(spark, layers, sheet, timed, keyed):
    import random

    from tierlake.operators.snapshots import merge_snapshots, snapshots_along

    pick = random.Random(3)
    days = [date(2026, 1, d) for d in range(1, 8)]
    data = [(pick.choice(["a", "b", "c", None]), pick.choice([None, 1, 2, 3, 4]), pick.randrange(3), pick.choice(days))
            for _ in range(120)]
    df = spark.createDataFrame(data, "k string, t int, v int, snapshot_date date")
    keys, order = (["k"] if keyed else []), ("t" if timed else None)
    found = snapshots_along(df, days, keys, order)
    state = None
    for day in days:
        batch = df.filter(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")
        state = latest_per_key(batch, keys, order) if state is None else merge_snapshots(state, batch, keys, order, previous_unique=keyed)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert rows(found.filter(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")) == rows(state)


def test_snapshots_know_their_keys(spark, layers, sheet, quotes):
    from tierlake.plans.bronze import _built_with

    no_keys = sheet([(f.name, f.datatype) for f in quotes.fields], (), "received_at")
    for name, contract in ((DAY1, no_keys), (DAY2, quotes)):
        ingest(spark, layers, "quotes", day(spark, name), contract, name)
        bronze_delta(spark, layers, "quotes", name, contract)
    table = layers.resolve("quotes", "bronze")
    assert [_built_with(spark, table, date.fromisoformat(d), quotes) for d in (DAY1, DAY2)] == [False, True]
    assert rebuild_from(spark, layers, "quotes", DAY1, quotes) == [date.fromisoformat(d) for d in (DAY1, DAY2)]
    assert _built_with(spark, table, date.fromisoformat(DAY1), quotes)
    assert state(spark, layers, "quotes", DAY2) == {"1333": 102.0, "13": 25000.0, "11536": 150.0}


def test_ingest_computes_its_source_once(spark, layers, sheet):
    seen = spark.sparkContext.accumulator(0)
    source = spark.createDataFrame(
        spark.sparkContext.parallelize(range(20), 4).map(lambda i: seen.add(1) or (i,)), "id bigint").repartition(3)
    assert ingest(spark, layers, "once", source, sheet([("id", "bigint")]), DAY1) == 20
    assert seen.value == 20
