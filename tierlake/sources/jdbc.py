"""JDBC table scan with projection and equality filters pushed to the database."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.names import identifier


def table_options(options: Mapping[str, str], table: str, schema: str | None = None, *,
                  split_column: str | None = None, bounds: tuple | None = None,
                  splits: int = 1) -> dict[str, str]:
    """Reader options. With a split column the table is read by ``splits`` connections."""
    names = [identifier(n) for n in (schema, table) if n]
    result = {**options, "dbtable": ".".join(f'"{name}"' for name in names)}
    if split_column:
        if not bounds or splits < 1:
            raise ValueError("A split column needs bounds and a number of splits")
        result |= {
            "partitionColumn": identifier(split_column), "numPartitions": str(splits),
            "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
        }
    return result


def narrow(df: DataFrame, columns: Sequence[str] | None = None,
           filters: Mapping[str, object] | None = None) -> DataFrame:
    """Projection, then equality filters on it; Spark pushes both into the scan."""
    if columns:
        df = df.select(*(identifier(name) for name in columns))
    for name, value in (filters or {}).items():
        df = df.filter(F.col(identifier(name)) == F.lit(value))
    return df


def read_table(spark: SparkSession, options: Mapping[str, str], table: str, schema: str | None = None,
               columns: Sequence[str] | None = None, filters: Mapping[str, object] | None = None,
               **split) -> DataFrame:
    """``options`` holds url, user, password and driver."""
    scan = spark.read.format("jdbc").options(**table_options(options, table, schema, **split))
    return narrow(scan.load(), columns, filters)
