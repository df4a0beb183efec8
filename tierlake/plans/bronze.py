"""Lake to Bronze: one full snapshot of the current state per run date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.contract import Contract
from tierlake.names import Layers, TableName, job_name, run_day
from tierlake.operators.filters import on_date, require_rows
from tierlake.operators.snapshots import latest_per_key, merge_snapshots, snapshots_along

# The keys that the snapshot of a date was built with, as a property of the table for each date.
_KEYS = "tierlake.keys"


def read_lake(spark: SparkSession, layers: Layers, app: str, day: date) -> DataFrame:
    """The Lake rows of one ingest date, without that column; there must be some."""
    rows = on_date(tables.read(spark, layers.resolve(app, "lake")), "ingest_date", day)
    require_rows(rows, f"No Lake rows for {app} on {day}; Bronze was not changed")
    return rows.drop("ingest_date")


def latest_snapshot(spark: SparkSession, table: TableName, before: str | date) -> date | None:
    """The last snapshot date strictly before a day; reads the catalog only."""
    if not tables.exists(spark, table):
        return None
    return tables.latest_partition(spark, table, "snapshot_date", run_day(before))


def read_snapshot(spark: SparkSession, table: TableName, day: str | date) -> DataFrame:
    return on_date(tables.read(spark, table), "snapshot_date", day).drop("snapshot_date")


def _note(day: date) -> str:
    return f"{_KEYS}.{day.isoformat()}"


def _write(spark: SparkSession, table: TableName, rows: DataFrame, days: Sequence[date], contract: Contract) -> int:
    """Write the snapshots of some dates, by their column ``snapshot_date``, and note their keys."""
    keys, one = ",".join(contract.keys), len(days) == 1
    if not tables.exists(spark, table):
        return tables.replace(spark, table, rows, ["snapshot_date"], rebalance=not one,
                              notes={_note(day): keys for day in days})
    known = tables.properties(spark, table)
    changed = [day for day in days if known.get(_note(day)) != keys]
    # Unknown first: a job that is lost on the way leaves no date with keys that it does not have.
    for day in changed:
        tables.set_property(spark, table, _note(day), "")
    count = tables.overwrite_partitions(spark, table, rows, rebalance=not one)
    for day in changed:
        tables.set_property(spark, table, _note(day), keys)
    return count


def bronze_full(spark: SparkSession, layers: Layers, app: str, run_date: str, contract: Contract) -> int:
    """The snapshot of a run date from that day's Lake rows alone."""
    day, table = run_day(run_date), layers.resolve(job_name(app), "bronze")
    layers.ensure(spark, "bronze")
    rows = latest_per_key(read_lake(spark, layers, app, day), contract.keys, contract.order_by)
    return _write(spark, table, rows.withColumn("snapshot_date", F.lit(day)), [day], contract)


def bronze_delta(spark: SparkSession, layers: Layers, app: str, run_date: str, contract: Contract) -> int:
    """The snapshot of a run date: the last earlier one brought up to date with the Lake rows.

    Only strictly earlier snapshots are read, so a second run gives the same result.
    Without an earlier snapshot it is a full run.
    """
    day, table = run_day(run_date), layers.resolve(job_name(app), "bronze")
    layers.ensure(spark, "bronze")
    batch = read_lake(spark, layers, app, day)
    last = latest_snapshot(spark, table, day)
    if last is None:
        rows = latest_per_key(batch, contract.keys, contract.order_by)
    else:
        rows = merge_snapshots(
            read_snapshot(spark, table, last), batch, contract.keys, contract.order_by,
            previous_unique=_built_with(spark, table, last, contract))
    return _write(spark, table, rows.withColumn("snapshot_date", F.lit(day)), [day], contract)


def _built_with(spark: SparkSession, table: TableName, day: date, contract: Contract) -> bool:
    return bool(contract.keys) and tables.properties(spark, table).get(_note(day)) == ",".join(contract.keys)


def rebuild_from(spark: SparkSession, layers: Layers, app: str, first: str, contract: Contract) -> list[date]:
    """Build the snapshots of every Lake date from ``first`` on, as a chain of deltas would.

    A delta for an old date does not change the snapshots after it; this does. It is one job,
    however many dates there are: the Lake rows from ``first`` on and the last snapshot before
    it become one row per key and ingest date, a key's best row so far along the dates is its
    state, and a state holds from its date until the key's next one.
    """
    table, lake = layers.resolve(job_name(app), "bronze"), layers.resolve(app, "lake")
    start = run_day(first)
    found = F.regexp_extract("partition", "(?:^|/)ingest_date=([^/]+)", 1)
    days = (spark.sql(f"SHOW PARTITIONS {tables.physical(spark, lake).sql}").select(F.to_date(found).alias("d"))
            .filter(F.col("d") >= F.lit(start)).distinct().orderBy("d"))
    done = [row["d"] for row in days.collect()]
    if not done:
        return done
    layers.ensure(spark, "bronze")
    rows = tables.read(spark, lake).filter(F.col("ingest_date").between(F.lit(done[0]), F.lit(done[-1])))
    rows = rows.withColumnRenamed("ingest_date", "snapshot_date")
    last = latest_snapshot(spark, table, start)
    if last is not None:
        before = read_snapshot(spark, table, last).withColumn("snapshot_date", F.lit(last))
        rows = rows.unionByName(before.select(*rows.columns))
    _write(spark, table, snapshots_along(rows, done, contract.keys, contract.order_by), done, contract)
    return done
