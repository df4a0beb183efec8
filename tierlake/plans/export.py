"""Export of a frame to a warehouse table over JDBC, all rows or none.

Spark writes the rows in parallel into a staging table beside the target. One
transaction then deletes what is to be replaced and inserts from the staging table.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.names import identifier, run_day
from tierlake.operators.filters import date_scope

BATCH_ROWS = 5000
CONNECTIONS = 16
STRATEGIES = ("append", "truncate", "delete_and_insert")

# Source type names without parameters -> warehouse types.
WAREHOUSE_TYPES = {
    "tinyint": "NUMBER(19)", "smallint": "NUMBER(19)", "int": "NUMBER(19)",
    "integer": "NUMBER(19)", "bigint": "NUMBER(19)",
    "float": "BINARY_DOUBLE", "real": "BINARY_DOUBLE", "double": "BINARY_DOUBLE",
    "boolean": "NUMBER(1)", "date": "DATE", "uuid": "VARCHAR2(36)",
    "varbinary": "BLOB", "binary": "BLOB", "json": "CLOB", "variant": "CLOB",
    "string": "CLOB", "varchar": "CLOB", "char": "CHAR(255 CHAR)",
}
LONGEST_VARCHAR, LONGEST_CHAR, WIDEST_NUMBER = 4000, 2000, 38


@dataclass(frozen=True)
class Kind:
    """A type as base name, numbers in brackets, and whether it has a time zone."""

    base: str
    sizes: tuple[int, ...] = ()
    zoned: bool = False

    @classmethod
    def of(cls, kind: T.DataType | str) -> "Kind":
        if isinstance(kind, T.DecimalType):
            return cls("decimal", (kind.precision, kind.scale))
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return cls("timestamp", (6,), isinstance(kind, T.TimestampType))
        text = kind if isinstance(kind, str) else kind.simpleString()
        words = text.lower().replace(",", " ").replace("(", " ( ").replace(")", " ) ").split()
        zoned = words[-3:] == ["with", "time", "zone"]
        words = words[:-3] if zoned else words
        sizes = words[2:-1] if words[1:2] == ["("] and words[-1:] == [")"] else []
        if words and all(size.isdigit() for size in sizes) and len(words) == (len(sizes) + 3 if sizes else 1):
            return cls(words[0], tuple(map(int, sizes)), zoned)
        return cls(text)


def _text_type(kind: Kind) -> str:
    longest, form = (LONGEST_VARCHAR, "VARCHAR2") if kind.base == "varchar" else (LONGEST_CHAR, "CHAR")
    size = kind.sizes[0]
    return f"{form}({size} CHAR)" if 0 < size <= longest else "CLOB"


def _number_type(kind: Kind) -> str | None:
    digits, scale = (*kind.sizes, 0)[:2] if kind.sizes else (0, 0)
    fits = 1 <= digits <= WIDEST_NUMBER and scale <= digits
    return f"NUMBER({digits},{scale})" if fits else None


def _moment_type(kind: Kind) -> str:
    zone = " WITH TIME ZONE" if kind.zoned else ""
    return f"TIMESTAMP({kind.sizes[0] if kind.sizes else 6}){zone}"


def ddl_type(kind: T.DataType | str) -> str:
    """Warehouse type of a Spark type or of a source type name."""
    parts = Kind.of(kind)
    made = None
    if not parts.sizes and not parts.zoned and parts.base in WAREHOUSE_TYPES:
        made = WAREHOUSE_TYPES[parts.base]
    elif parts.base in ("varchar", "char") and len(parts.sizes) == 1:
        made = _text_type(parts)
    elif parts.base in ("decimal", "numeric") and len(parts.sizes) == 2:
        made = _number_type(parts)
    elif parts.base == "timestamp":
        made = _moment_type(parts)
    elif parts.base == "time":
        made = "VARCHAR2(64)"
    if made is None:
        raise ValueError(f"The warehouse has no type for {kind}; turn complex values into JSON text first")
    return made


def _source_type(field: T.StructField) -> T.DataType | str:
    # A varchar(n) or char(n) table column is a string with its declared type beside it.
    return field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", field.dataType)


def target_name(table: str) -> str:
    parts = str(table).split(".")
    if len(parts) > 2 or not all(re.match("[A-Za-z]", part) for part in parts):
        raise ValueError(f"{table!r} is no table name, with or without its schema")
    return ".".join(identifier(part) for part in parts)


def column_names(df: DataFrame) -> list[str]:
    """Upper-case names of the columns, which the warehouse must be able to tell apart."""
    seen: dict[str, str] = {}
    for name in df.columns:
        twin = seen.setdefault(identifier(name, "column name").upper(), name)
        if twin is not name:
            raise ValueError(f"The warehouse cannot tell the columns {twin!r} and {name!r} apart")
    if not seen:
        raise ValueError("There is no column to export")
    return list(seen)


def converted(df: DataFrame) -> DataFrame:
    """Upper-case columns; booleans as 0 and 1, times as ISO text, variants as JSON text."""
    def value(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            return column.cast("int")
        if isinstance(field.dataType, T.VariantType):
            return F.to_json(column)
        if field.dataType.simpleString().startswith("time("):
            return column.cast("string")
        return column

    return df.select(*(value(f).alias(n) for f, n in zip(df.schema, column_names(df))))


@dataclass(frozen=True)
class Statement:
    sql: str
    days: tuple[date, ...] = ()


def create_statement(df: DataFrame, table: str) -> Statement:
    columns = ", ".join(
        f'"{n}" {ddl_type(_source_type(f))}' for n, f in zip(column_names(df), df.schema))
    return Statement(f"CREATE TABLE {target_name(table)} ({columns})")


def load_statements(names: list[str], table: str, staging: str, strategy: str,
                    date_column: str | None = None, day: str | None = None) -> list[Statement]:
    """The statements of the one transaction that publishes the staged rows."""
    table = target_name(table)
    listed = ", ".join(f'"{name}"' for name in names)
    insert = Statement(f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging}")
    if strategy == "append":
        return [insert]
    if strategy == "truncate":
        # DELETE, because TRUNCATE would commit on its own.
        return [Statement(f"DELETE FROM {table}"), insert]
    if strategy != "delete_and_insert":
        raise ValueError(f"Rows are exported by {', '.join(STRATEGIES)}, not by {strategy!r}")
    if not date_column:
        raise ValueError("delete_and_insert replaces one date: give the date_column")
    column, start = f'"{identifier(date_column).upper()}"', run_day(day)
    scope = f"DELETE FROM {table} WHERE {column} >= ? AND {column} < ?"
    return [Statement(scope, (start, start + timedelta(days=1))), insert]


def jdbc_connection(spark: SparkSession, options: Mapping[str, str]):
    """A java.sql.Connection of the driver process."""
    java = spark._jvm.java
    if options.get("driver"):
        java.lang.Class.forName(options["driver"])
    return java.sql.DriverManager.getConnection(
        options["url"], options.get("user"), options.get("password"))


def run_transaction(connection, statements: list[Statement], to_sql_date: Callable) -> None:
    """All statements or none."""
    connection.setAutoCommit(False)
    try:
        for statement in statements:
            prepared = connection.prepareStatement(statement.sql)
            try:
                for position, value in enumerate(statement.days, 1):
                    prepared.setDate(position, to_sql_date(value))
                prepared.executeUpdate()
            finally:
                prepared.close()
        connection.commit()
    except BaseException:
        connection.rollback()
        raise


def _run(connection, sql: str) -> None:
    statement = connection.createStatement()
    try:
        statement.execute(sql)
    finally:
        statement.close()


def _present(connection, table: str) -> bool:
    """Whether the catalog lists the table; a failing connection is an error, not an absent table."""
    schema, _, name = table.upper().rpartition(".")
    found = connection.getMetaData().getTables(None, schema or None, name, None)
    try:
        return bool(found.next())
    finally:
        found.close()


def _count(connection, table: str) -> int:
    statement = connection.createStatement()
    try:
        rows = statement.executeQuery(f"SELECT COUNT(*) FROM {table}")
        rows.next()
        return rows.getLong(1)
    finally:
        statement.close()


def staging_options(options: Mapping[str, str], staging: str) -> dict[str, str]:
    return {"batchsize": str(BATCH_ROWS), "numPartitions": str(CONNECTIONS), **options, "dbtable": staging}


def write_staging(df: DataFrame, options: Mapping[str, str], staging: str) -> None:
    options = staging_options(options, staging)
    # Spark would coalesce to numPartitions and run the whole stage before it in as many
    # tasks; after a shuffle only the writing tasks are that few.
    rows = df.repartition(int(options["numPartitions"]))
    rows.write.format("jdbc").options(**options).mode("append").save()


def export_jdbc(spark: SparkSession, df: DataFrame, options: Mapping[str, str], table: str, strategy: str,
                date_column: str | None = None, day: str | None = None, *,
                connect: Callable = jdbc_connection, stage: Callable = write_staging) -> int:
    """Export and return the row count. ``options``: url, user, password, driver.

    A Spark task that runs again after a lost executor may stage its rows twice. The staged
    rows are therefore counted against the frame before anything is published.
    """
    names = column_names(df)
    staging = f"{target_name(table)}_S{uuid.uuid4().hex[:8].upper()}"
    statements = load_statements(names, table, staging, strategy, date_column, day)
    create = create_statement(df, table)
    if strategy == "delete_and_insert":
        match = [c for c in df.columns if c.lower() == date_column.lower()]
        if not match:
            raise ValueError(f"No column {date_column!r}")
        df = date_scope(df, match[0], day)
    seen = Observation()
    rows = converted(df).observe(seen, F.count(F.lit(1)).alias("rows"))
    connection = connect(spark, options)
    try:
        if not _present(connection, target_name(table)):
            _run(connection, create.sql)
        _run(connection, create_statement(df, staging).sql)
        try:
            stage(rows, options, staging)
            staged, expected = _count(connection, staging), seen.get["rows"]
            if staged != expected:
                raise RuntimeError(f"Staged {staged} rows of {expected}; nothing was exported")
            run_transaction(connection, statements,
                            lambda d: spark._jvm.java.sql.Date.valueOf(d.isoformat()))
        finally:
            connection.setAutoCommit(True)
            _run(connection, f"DROP TABLE {staging}")
        return expected
    finally:
        connection.close()
