"""Run history, ad-hoc queries and the catalog listing."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.names import Layers, run_day
from tierlake.operators.sequences import numbered
from tierlake.operators.snapshots import latest_per_key

RUNS = "job string, run_date date, started_at timestamp, ended_at timestamp, status string"


def record_run(spark: SparkSession, layers: Layers, job: str, run_date: str | date,
               started_at: datetime, ended_at: datetime, status: str) -> None:
    """Append one run to the history."""
    table = layers.resolve("runs", "audit")
    layers.ensure(spark, "audit")
    row = spark.createDataFrame([(job, run_day(run_date), started_at, ended_at, status)], RUNS)
    if tables.exists(spark, table):
        tables.append(spark, table, row)
    else:
        tables.replace(spark, table, row)


def audited(spark: SparkSession, layers: Layers, job: str, run_date: str, work: Callable[[], object]):
    """Run a job and record its outcome, also when it fails."""
    started, status = datetime.now(timezone.utc), "failed"
    try:
        result = work()
        status = "success"
        return result
    finally:
        record_run(spark, layers, job, run_date, started, datetime.now(timezone.utc), status)


def attempts(runs: DataFrame) -> DataFrame:
    """Number the runs of a job and date by start time, as column ``attempt``."""
    order = [F.col("started_at"), F.col("ended_at"), F.col("status")]
    return numbered(runs, ["job", "run_date"], [F.date_trunc("minute", "started_at")], order, "attempt")


def last_status(runs: DataFrame) -> DataFrame:
    """The newest run of every job."""
    return latest_per_key(runs, ["job"], "started_at")


def run_history(runs: DataFrame, job: str | None = None, limit: int = 50,
                jobs: DataFrame | None = None) -> DataFrame:
    """The newest runs first, with the columns of ``jobs`` (keyed by ``job``) when given."""
    if job is not None:
        runs = runs.filter(F.col("job") == job)
    newest = runs.orderBy(F.col("started_at").desc(), "job", "run_date").limit(limit)
    if jobs is None:
        return newest
    return newest.join(jobs, "job", "left").orderBy(F.col("started_at").desc(), "job", "run_date")


def read_runs(spark: SparkSession, layers: Layers) -> DataFrame:
    return tables.read(spark, layers.resolve("runs", "audit"))


def run_sql(spark: SparkSession, query: str, limit: int | None = None) -> DataFrame:
    """An ad-hoc query over the layers. Its whole answer, unless a number of rows is asked for."""
    answer = spark.sql(query)
    return answer if limit is None else answer.limit(limit)


def list_columns(spark: SparkSession, layers: Layers, layer: str | None = None) -> DataFrame:
    """``(database, table, position, column, type)`` of the logical tables."""
    names = ("lake", "bronze", "silver", "gold") if layer is None else (layer,)
    rows = []
    for database in map(layers.database, names):
        if not spark.catalog.databaseExists(database):
            continue
        for table in spark.catalog.listTables(database):
            if table.isTemporary or re.search(r"__[0-9a-f]{16}$", table.name):
                continue
            fields = spark.table(f"`{database}`.`{table.name}`").schema
            rows += [(database, table.name, i, f.name, f.dataType.simpleString())
                     for i, f in enumerate(fields, 1)]
    return spark.createDataFrame(
        rows, "database string, `table` string, position int, `column` string, type string")
