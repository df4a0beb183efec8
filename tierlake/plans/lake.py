"""Source to Lake: check, cast, protect, stamp, write one ingest date."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.contract import Contract
from tierlake.functions.privacy import Keys, protect
from tierlake.names import Layers, TableName, identifier, job_name, run_day

MODES = ("append", "overwrite", "replace")


def prepare(df: DataFrame, contract: Contract, keys: Keys = Keys()) -> DataFrame:
    """Column check, typed cast and column protection: two projections, no job."""
    contract.check(df)
    return protect(contract.cast(df), contract, keys)


def write_lake(spark: SparkSession, df: DataFrame, table: TableName, ingest_date: str,
               mode: str = "overwrite", extra_partitions: Mapping[str, object] | None = None) -> int:
    """Stamp the ingest date and write. Returns the row count.

    ``append`` keeps what is there, also on a replay. ``overwrite`` replaces the partitions
    that the batch writes, ``replace`` the whole table. All rows go to one partition, so
    every scan task writes its own file and nothing is shuffled.
    """
    if mode not in MODES:
        raise ValueError(f"The Lake is written by {', '.join(MODES)}, not by {mode!r}")
    extras = {job_name(k, "partition column"): v for k, v in (extra_partitions or {}).items()}
    stamped = df.withColumns({
        "ingest_date": F.lit(run_day(ingest_date)),
        **{name: F.lit(value) for name, value in extras.items()},
    })
    parts = [*extras, "ingest_date"]
    # The rows are counted by the write: looking for a first one would run a shuffle in front of it twice.
    try:
        if mode == "replace" or not tables.exists(spark, table):
            count = tables.replace(spark, table, stamped, parts, rebalance=False)
        elif mode == "append":
            count = tables.append(spark, table, stamped)
        else:
            count = tables.overwrite_partitions(spark, table, stamped, rebalance=False)
    except tables.NoRows:
        count = 0
    if count == 0:
        raise ValueError("The source has no rows for the Lake; nothing was written")
    return count


def ingest(spark: SparkSession, layers: Layers, app: str, df: DataFrame, contract: Contract,
           ingest_date: str, mode: str = "overwrite", keys: Keys = Keys(),
           extra_partitions: Mapping[str, object] | None = None) -> int:
    """The Lake job for a frame that a source has read."""
    table = layers.resolve(job_name(identifier(app)), "lake")
    rows = prepare(df, contract, keys)
    layers.ensure(spark, "lake")
    return write_lake(spark, rows, table, ingest_date, mode, extra_partitions)
