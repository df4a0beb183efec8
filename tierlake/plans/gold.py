"""Silver to Gold: replace, append or replace one date, each published at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierlake import tables
from tierlake.names import Layers, TableName, identifier, run_day
from tierlake.operators.filters import date_scope, require_rows

STRATEGIES = {"replace": "replace", "truncate": "replace", "append": "append",
              "delete_and_insert": "delete_and_insert"}


def plan_publish(layers: Layers, silver: str, gold: str, strategy: str = "replace",
                 date_column: str | None = None, day: str | None = None) -> tuple[TableName, TableName, str]:
    """Check the arguments without reading anything: (source, target, strategy)."""
    source, target = layers.resolve(silver, "silver"), layers.resolve(gold, "gold")
    if strategy not in STRATEGIES:
        raise ValueError(f"Gold can be published by {', '.join(STRATEGIES)}, not by {strategy!r}")
    if day is not None:
        run_day(day)
    if STRATEGIES[strategy] == "delete_and_insert":
        if day is None:
            raise ValueError("delete_and_insert replaces one date: give its run_date")
        if not date_column:
            raise ValueError("delete_and_insert replaces one date: give the date_column")
        identifier(date_column)
    return source, target, STRATEGIES[strategy]


def _partitioning(source: DataFrame, name: str) -> tuple[list[str], str | None]:
    """(partition columns, timestamp column whose day partitions) for a column of the source."""
    field = next((f for f in source.schema if f.name.lower() == identifier(name).lower()), None)
    if field is not None and isinstance(field.dataType, T.DateType):
        return [field.name], None
    if field is not None and isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return [], field.name
    raise ValueError(f"Gold is partitioned by a DATE or TIMESTAMP column of Silver; {name!r} is none")


def publish_gold(spark: SparkSession, layers: Layers, silver: str, gold: str, strategy: str = "replace",
                 date_column: str | None = None, day: str | None = None,
                 partition_by: str | None = None, verify: str | None = "rows") -> int:
    """Publish a Silver table. Returns the number of Silver rows published.

    ``verify`` compares what was written with what is then there: ``rows``, or ``values`` too.

    ``replace`` refuses an empty source and may change the schema. ``append`` of nothing
    is 0. ``delete_and_insert`` keeps the other dates and the rows without one. A Gold table
    that was published with ``partition_by`` its date column, or by the day of its timestamp
    column, has just that partition rewritten; else a new version with all kept rows is
    published.
    """
    source_name, target_name, strategy = plan_publish(layers, silver, gold, strategy, date_column, day)
    source = tables.read(spark, source_name)
    if strategy == "delete_and_insert":
        match = [f for f in source.schema if f.name.lower() == date_column.lower()]
        kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
        if not match or not isinstance(match[0].dataType, kinds):
            raise ValueError(f"{date_column!r} is no DATE or TIMESTAMP column of Silver")
        date_column = match[0].name
        source = date_scope(source, date_column, day)
    if source.isEmpty():
        if strategy == "append":
            return 0
        require_rows(source, "There is nothing in Silver to publish; Gold stays as it is")
    layers.ensure(spark, "gold")
    present = tables.exists(spark, target_name)
    parts, day_of = [], None
    if present:
        target = tables.read(spark, target_name)
        if strategy != "replace":
            tables.check_compatible(source, target)
            # Names may differ in case; the published ones stay.
            source = source.toDF(*target.columns)
        day_of = tables.day_of(spark, target_name)
        day_of = day_of if day_of in source.columns else None
        parts = [p for p in tables.partition_columns(spark, target_name) if p in source.columns]
    if partition_by is None and strategy == "delete_and_insert" and not present:
        # So that the next date replaces one partition.
        partition_by = date_column
    if partition_by:
        parts, day_of = _partitioning(source, partition_by)
    if strategy == "append" and present:
        return tables.append(spark, target_name, source, verify=bool(verify))
    if strategy == "delete_and_insert" and present:
        column = next(c for c in target.columns if c.lower() == date_column.lower())
        if column in (tables.day_of(spark, target_name), *tables.partition_columns(spark, target_name)):
            return tables.overwrite_partitions(spark, target_name, source, rebalance=False, verify=verify)
        kept = date_scope(target, column, day, keep=True)
        tables.replace(spark, target_name, kept.unionByName(source), parts, day=day_of, verify=verify)
        # Every row of that day in the new version comes from Silver.
        return date_scope(tables.read(spark, target_name), column, day).count()
    return tables.replace(spark, target_name, source, parts, day=day_of, verify=verify)
