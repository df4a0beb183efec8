"""Registry of the checked queries, and their common inputs and output form."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake import Contract, Layers, configure
from tierlake.session import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the DuckDB text of the same result."""
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(configure(spark), sf_dir))

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text and decimals as doubles, to compare across engines."""
    def column(field: T.StructField):
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        return value.alias(field.name)

    return df.select(*(column(field) for field in df.schema))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A session view of a table, for specifications and ad-hoc SQL."""
    load(spark, sf_dir, name).createOrReplaceTempView(f"src_{name}")
    return f"src_{name}"


def layers(spark: SparkSession) -> Layers:
    """Fresh namespaces below the shared folder, so that queries do not meet."""
    mark = uuid.uuid4().hex[:8]
    return Layers(*(f"{name}_{mark}" for name in ("lake", "bronze", "silver", "gold", "audit")),
                  root=workspace(spark, "layers"))


def contract(spark: SparkSession, sheet: str) -> Contract:
    """A contract from sheet lines ``name type [key] [time] [hash|pii|mask] [p,s]``."""
    rows = []
    for line in sheet.strip().splitlines():
        name, datatype, *marks = line.split()
        size = next((mark.split(",") for mark in marks if "," in mark), (None, None))
        level = next((mark for mark in marks if mark in ("hash", "pii", "mask")), None)
        rows.append((name, datatype, level, "Y" if "key" in marks else "N",
                     "Y" if "time" in marks else "N", *size))
    columns = "column_name, datatype, security_level, primary_key, is_timestamp, data_length, data_precision"
    schema = ", ".join(f"{name.strip()} string" for name in columns.split(","))
    return Contract.from_frame(spark.createDataFrame(rows, schema))


EVENTS = """
event_id bigint
ts timestamp time
user_id bigint key
event_type string key
value double
props string
"""

EVENTS_BY_ID = EVENTS.replace("event_id bigint", "event_id bigint key").replace(
    "user_id bigint key", "user_id bigint").replace("event_type string key", "event_type string")


def stamp(column: str) -> str:
    """DuckDB text of a timestamp in the output form."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


EVENT_COLUMNS = f"event_id, {stamp('ts')} AS ts, user_id, event_type, value, props"
ORDER_COLUMNS = (f"o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                 f"{stamp('o_orderdate')} AS o_orderdate, o_orderpriority")
