"""Data tests after a write that leave out the history which was tested before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import key_index, tables
from tierlake.names import TableName
from tierlake.operators.quality import run_tests

_UNIQUE = ("unique", "unique_combination")


def _rows_of_keys(spark: SparkSession, table: TableName, batch: DataFrame, columns: Sequence[str], slots: int,
                  nulls: bool) -> DataFrame:
    """The key columns of a table's rows that have a key of the batch, from partitions that may hold one."""
    rows = tables.read(spark, table)
    keys = batch.select(*(F.col(f"`{c}`").cast(rows.schema[c].dataType).alias(c) for c in columns)).distinct()
    found = rows.filter(tables.holding(spark, table, batch, columns, slots)).select(*columns).join(
        keys.dropna(), list(columns), "left_semi")
    missing = reduce(Column.__or__, (F.col(f"`{c}`").isNull() for c in columns))
    if not nulls or keys.filter(missing).isEmpty():
        return found
    # No index has a key with nulls. The statistics of the files tell where a column has some.
    other = keys.filter(missing).select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)))
    same = reduce(Column.__and__, (F.col(f"`{c}`").eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(columns)))
    return found.unionByName(rows.filter(missing).select(*columns).join(other, same, "left_semi"))


def run_batch_tests(spark: SparkSession, table: TableName, batch: DataFrame, tests: Sequence[Mapping],
                    slots: int = key_index.SLOTS) -> DataFrame:
    """The report of ``run_tests`` on a table that passed before ``batch`` was written to it.

    Tests of rows look at the batch. A key can only have become a repeated one if the batch has it, so
    uniqueness is tested on the keys of the batch, in the partitions that the table's key index names for
    them; other partitions are not opened. An index is built by one pass over the key columns where there
    is none, so writes between two tests should keep it (``tables.append(keep_index=True)``, merges do).
    Of a table that did not pass before, repeats that the batch has no part in are not seen.
    """
    parts = []
    of_rows = [test for test in tests if test["test"] not in _UNIQUE]
    if of_rows:
        parts.append(run_tests(batch, of_rows))
    for test in tests:
        if test["test"] in _UNIQUE:
            single = test["test"] == "unique"
            columns = [test["column"]] if single else list(test["columns"])
            parts.append(run_tests(_rows_of_keys(spark, table, batch, columns, slots, not single), [test]))
    if not parts:
        raise ValueError("No tests given")
    return reduce(DataFrame.unionByName, parts)
