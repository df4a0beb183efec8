"""Write patterns over partitioned Parquet tables in the session catalog.

A logical table is a view over one physical table. Replacing a table writes a new
physical table beside the old one and then points the view at it, so readers see
the old or the new state and never a mixture; the version before is kept for
queries that still run on it. Appends and partition overwrites go to the current
physical table. One writer per table at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierlake import key_index
from tierlake.names import TableName
from tierlake.operators import checksums

# What a logical table knows of itself, as properties of its view.
_CURRENT, _PREVIOUS = "tierlake.current", "tierlake.previous"
_PARTS, _DAY_OF, _HIDDEN = "tierlake.partitions", "tierlake.day_of", "tierlake.hidden"
_DAY = "_day"
# "<folder>:<slots>:<keys>" of every key index of the current version, joined by ";", below that table's own folder.
_INDEX = "tierlake.key_index"


def exists(spark: SparkSession, table: TableName) -> bool:
    return spark.catalog.tableExists(table.sql)


def properties(spark: SparkSession, table: TableName) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table.sql}").collect()
    return {row["key"]: row["value"] for row in rows}


def set_property(spark: SparkSession, table: TableName, key: str, value: str) -> None:
    spark.sql(f"ALTER VIEW {table.sql} SET TBLPROPERTIES ('{key}' = '{value}')")


def physical(spark: SparkSession, table: TableName) -> TableName:
    return TableName(table.database, properties(spark, table)[_CURRENT])


def partition_columns(spark: SparkSession, table: TableName) -> list[str]:
    return [name for name in properties(spark, table).get(_PARTS, "").split(",") if name]


def day_of(spark: SparkSession, table: TableName) -> str | None:
    """The timestamp column whose day partitions the physical table, if there is one."""
    return properties(spark, table).get(_DAY_OF)


def read(spark: SparkSession, table: TableName) -> DataFrame:
    return spark.table(table.sql)


def spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together and split large ones into even files.

    Without it each task writes a file into every partition it meets. AQE sizes the
    shuffle partitions, so a partition value that holds most rows is still written
    by many tasks.
    """
    return df.hint("rebalance", *(F.col(c) for c in partition_by)) if partition_by else df


class NoRows(ValueError):
    """A table was to be replaced with no rows."""


class Mismatch(RuntimeError):
    """What readers see is not what was written."""


def _counted(df: DataFrame, verify: str | None = None, parts: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    # Observed in the stage that writes: stages before it may run again after a
    # lost executor and would be counted twice.
    if verify not in (None, "rows", "values"):
        raise ValueError(f"A write is verified by rows or by values, not by {verify!r}")
    seen = Observation()
    wanted = checksums.totals(df, sorted(df.columns)) if verify == "values" else [F.count(F.lit(1)).alias("rows")]
    if verify and parts:
        # As many as there are partitions in the batch.
        wanted.append(F.collect_set(F.struct(*(F.col(f"`{p}`") for p in parts))).alias("_parts"))
    return df.observe(seen, *wanted), seen


def _verify(found: DataFrame, wanted: Mapping, what: str) -> None:
    """Compare rows, and checksums if there are any, of a table or some of its partitions."""
    wanted = {key: value for key, value in wanted.items() if key != "_parts"}
    if len(wanted) == 1:
        got = {"rows": found.count()}  # from footers
    else:
        got = found.agg(*checksums.totals(found, sorted(found.columns))).first().asDict()
    if got != wanted:
        raise Mismatch(f"{what} holds {got} where {wanted} were written")


def replace(spark: SparkSession, table: TableName, df: DataFrame, partition_by: Sequence[str] = (),
            *, day: str | None = None, hidden: Sequence[str] = (), allow_empty: bool = False,
            rebalance: bool = True, notes: Mapping[str, str] | None = None, verify: str | None = None,
            condition: str | None = None) -> int:
    """Write ``df`` as a new version and point the table at it. Returns the row count.

    ``notes`` become properties of the table in the same step, so no reader and no later
    job sees the new version without them; those of the version before are not carried over.

    ``day`` names a timestamp column: the physical table is partitioned by its day, in a
    column that the view leaves out. So it does with the ``hidden`` text columns; rows that
    come without them later have null there. Readers see rows that meet the ``condition`` only.

    ``verify`` compares the new version with what was written before anybody sees it: its
    ``rows``, from footers, or its ``values`` too, by checksums, which reads it once.
    """
    known = properties(spark, table) if exists(spark, table) else {}
    target = TableName(table.database, f"{table.table}__{uuid.uuid4().hex[:16]}")
    columns = ", ".join(f"`{name}`" for name in df.columns if name not in hidden)
    if day:
        df, partition_by = df.withColumn(_DAY, F.to_date(day)), [_DAY]
    counted, seen = _counted(spread(df, partition_by) if rebalance else df, verify)
    # The option stays with the table: every later overwriting insert into it replaces only
    # the partitions it writes, whatever the session is set to.
    try:
        (counted.write.format("parquet").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).saveAsTable(target.sql))
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {target.sql}")
        raise
    rows = seen.get["rows"]
    if verify:
        try:
            _verify(spark.table(target.sql), seen.get, f"The new version of {table.sql}")
        except Mismatch:
            spark.sql(f"DROP TABLE IF EXISTS {target.sql}")
            raise
    if rows == 0 and not allow_empty:
        spark.sql(f"DROP TABLE {target.sql}")
        raise NoRows(f"Refusing to replace {table.sql} with no rows; it was not changed")
    notes = {**(notes or {}), _CURRENT: target.table, _PREVIOUS: known.get(_CURRENT, ""),
             _PARTS: ",".join(partition_by), _HIDDEN: ",".join(hidden)} | ({_DAY_OF: day} if day else {})
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in notes.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table.sql} TBLPROPERTIES ({listed}) "
              f"AS SELECT {columns} FROM {target.sql} WHERE {condition or 'true'}")
    if known.get(_PREVIOUS):
        spark.sql(f"DROP TABLE IF EXISTS {TableName(table.database, known[_PREVIOUS]).sql}")
    return rows


def show(spark: SparkSession, table: TableName, condition: str, notes: Mapping[str, str]) -> None:
    """Let readers see only rows of the current version that meet a condition, also on hidden columns.

    The view and its notes change in one step; a note of ``""`` stands for none.
    """
    known = {key: value for key, value in properties(spark, table).items() if key.startswith("tierlake.")}
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in {**known, **notes}.items())
    columns = ", ".join(f"`{name}`" for name in read(spark, table).columns)
    spark.sql(f"CREATE OR REPLACE VIEW {table.sql} TBLPROPERTIES ({listed}) AS SELECT {columns} "
              f"FROM {physical(spark, table).sql} WHERE {condition}")


def check_compatible(source: DataFrame, target: DataFrame) -> None:
    """Same names (any case), same order, same types."""
    def shape(df: DataFrame) -> list:
        return [(field.name.lower(), field.dataType) for field in df.schema]

    if shape(source) != shape(target):
        raise ValueError("Column names, order and types of source and target must match")


def _aligned(spark: SparkSession, table: TableName, df: DataFrame) -> tuple[str, DataFrame]:
    """Columns by name, in the order of the physical table; drift is an error."""
    notes = properties(spark, table)
    target = TableName(table.database, notes[_CURRENT]).sql
    columns = spark.table(target).columns
    if notes.get(_DAY_OF):
        df = df.withColumn(_DAY, F.to_date(notes[_DAY_OF]))
    for name in filter(None, notes.get(_HIDDEN, "").split(",")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    if sorted(c.lower() for c in df.columns) != sorted(c.lower() for c in columns):
        raise ValueError(f"Columns {df.columns} do not match those of {table.sql}: {columns}")
    return target, df.select(*(F.col(f"`{c}`") for c in columns))


def append(spark: SparkSession, table: TableName, df: DataFrame, *, verify: bool = False,
           keep_index: bool = False) -> int:
    """Add rows. ``verify`` counts the table, from footers, before and after.

    ``keep_index`` adds their keys to the key indexes, which are dropped otherwise. That reads ``df`` once
    more per index, so it must give the same rows each time, as a stored table does.
    """
    target, rows = _aligned(spark, table, df)
    if keep_index:
        _extend_indexes(spark, table, df)
    else:
        _forget_index(spark, table)
    before = spark.table(target).count() if verify else 0
    counted, seen = _counted(rows)
    counted.write.insertInto(target)
    if verify:
        _verify(spark.table(target), {"rows": before + seen.get["rows"]}, table.sql)
    return seen.get["rows"]


def overwrite_partitions(spark: SparkSession, table: TableName, df: DataFrame,
                         *, rebalance: bool = True, indexed: bool = False, verify: str | None = None) -> int:
    """Replace exactly the partitions that occur in ``df``, which may read the table itself.

    ``verify`` compares the partitions afterwards with what was written, by ``rows`` or ``values``.
    Key indexes are dropped unless ``indexed`` says that they already have the keys of ``df``.
    """
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table.sql} is not partitioned")
    target, rows = _aligned(spark, table, df)
    if not indexed:
        _forget_index(spark, table)
    if verify == "values":
        kinds = spark.table(target).schema
        rows = rows.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kinds))
    counted, seen = _counted(spread(rows, parts) if rebalance else rows, verify, parts)
    counted.write.insertInto(target, overwrite=True)
    if verify and seen.get["_parts"]:
        written = spark.table(target).filter(_any_of(parts, seen.get["_parts"]))
        _verify(written, seen.get, f"The rewritten part of {table.sql}")
    return seen.get["rows"]


def drop_partition(spark: SparkSession, table: TableName, values: dict) -> None:
    spec = ", ".join(
        f"`{name}` = " + ("NULL" if value is None else f"'{value}'") for name, value in values.items()
    )
    target = physical(spark, table).sql
    spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")


def _any_of(parts: Sequence[str], rows: Sequence) -> Column:
    """Predicate on bare partition columns, so the scan is pruned."""
    if len(parts) == 1:
        values = [row[parts[0]] for row in rows]
        known = F.col(parts[0]).isin(*(v for v in values if v is not None))
        return known | F.col(parts[0]).isNull() if None in values else known
    alternatives = [
        reduce(Column.__and__, (F.col(p).eqNullSafe(F.lit(row[p])) for p in parts)) for row in rows
    ]
    return reduce(Column.__or__, alternatives, F.lit(False))


@contextmanager
def staged(spark: SparkSession, table: TableName, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once beside a table, for steps that would each compute it again."""
    name = TableName(table.database, f"{table.table}__{uuid.uuid4().hex[:16]}")
    df.write.format("parquet").saveAsTable(name.sql)
    try:
        yield spark.table(name.sql)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name.sql}")


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``source``, and all rows of ``source``."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source)


def _forget_index(spark: SparkSession, table: TableName) -> None:
    """Take the key indexes out of use before rows are written that they do not know."""
    if properties(spark, table).get(_INDEX):
        spark.sql(f"ALTER VIEW {table.sql} UNSET TBLPROPERTIES IF EXISTS ('{_INDEX}')")


def _index_path(spark: SparkSession, table: TableName, folder: str) -> str:
    # A folder whose name begins with "_" is no part of the table, and goes when the version is dropped.
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {physical(spark, table).sql}").filter("col_name = 'Location'")
    return f"{found.first()['data_type'].rstrip('/')}/{folder}"


def _indexes(spark: SparkSession, table: TableName) -> dict[tuple[str, ...], tuple[str, int]]:
    """Folder and slots of every key index of a table, by its keys."""
    notes = (note.split(":", 2) for note in properties(spark, table).get(_INDEX, "").split(";") if note)
    return {tuple(keys.split(",")): (folder, int(slots)) for folder, slots, keys in notes}


def _write_index(spark: SparkSession, table: TableName, rows: DataFrame, slots: int, keys: Sequence[str]) -> str:
    """A new index, named by the table's note only once it is whole. Returns its path."""
    folder = f"_keys_{uuid.uuid4().hex[:16]}"
    path = _index_path(spark, table, folder)
    rows.write.parquet(path)
    known = {**_indexes(spark, table), tuple(keys): (folder, slots)}
    set_property(spark, table, _INDEX, ";".join(f"{place}:{n}:{','.join(of)}" for of, (place, n) in known.items()))
    return path


def _index(spark: SparkSession, table: TableName, keys: Sequence[str], slots: int) -> tuple[str, int]:
    """Path and slots of a table's key index; built by one pass over the key columns where there is none."""
    known = _indexes(spark, table).get(tuple(keys))
    if known:
        return _index_path(spark, table, known[0]), known[1]
    rows = key_index.bitmaps(read(spark, table), keys, partition_columns(spark, table), slots)
    return _write_index(spark, table, rows, slots, keys), slots


def _extend_indexes(spark: SparkSession, table: TableName, df: DataFrame) -> None:
    """Add the keys of rows that are about to be written: one too many costs a read, one too few would be lost."""
    parts, kinds = partition_columns(spark, table), read(spark, table).schema
    for keys, (folder, slots) in _indexes(spark, table).items():
        typed = df.select(*(F.col(f"`{c}`").cast(kinds[c].dataType).alias(c) for c in dict.fromkeys([*keys, *parts])))
        key_index.bitmaps(typed, keys, parts, slots).write.mode("append").parquet(_index_path(spark, table, folder))


def compact_index(spark: SparkSession, table: TableName) -> None:
    """Write the key indexes anew, with one row per partition and stretch."""
    for keys, (folder, slots) in _indexes(spark, table).items():
        rows = key_index.merged(spark.read.parquet(_index_path(spark, table, folder)), partition_columns(spark, table))
        _write_index(spark, table, rows, slots, keys)


def holding(spark: SparkSession, table: TableName, batch: DataFrame, keys: Sequence[str],
            slots: int = key_index.SLOTS) -> Column:
    """A predicate on partition columns: all partitions that may hold a key of ``batch``.

    Reads the key index alone, so partitions that cannot hold one are never opened.
    """
    parts = partition_columns(spark, table)
    if not parts:
        return F.lit(True)
    path, slots = _index(spark, table, keys, slots)
    kinds = read(spark, table).schema
    batch = batch.select(*(F.col(f"`{k}`").cast(kinds[k].dataType).alias(k) for k in keys))
    # As many rows as there are partitions at most.
    return _any_of(parts, key_index.holders(spark.read.parquet(path), batch, keys, parts, slots).collect())


def merge_by_key(spark: SparkSession, table: TableName, source: DataFrame, keys: Sequence[str],
                 partition_by: Sequence[str] = (), *, atomic: bool = False, stage: bool = False,
                 slots: int = key_index.SLOTS, verify: str | None = None, rebalance: bool = True) -> int:
    """Update rows with a known key, insert the others. Returns the rows written.

    Only partitions that hold a matched key or receive a row are rewritten. Which ones may hold
    a key is read from an index of bitmaps beside the table (``key_index``; ``slots`` for one
    that is made now), so other partitions are not even scanned for keys. With several
    touched partitions the change becomes visible partition by partition;
    ``atomic`` publishes a whole new version instead. Running it again with the same
    source gives the same table. The source is read several times, mostly by few columns;
    ``stage`` writes it out first, which pays for one that takes more than a scan. ``rebalance=False``
    is for a source of one partition: each task then writes its own file, and no row is shuffled for the write alone.
    """
    if not keys:
        raise ValueError("A merge needs at least one key column")
    if stage:
        with staged(spark, table, source) as rows:
            return merge_by_key(spark, table, rows, keys, partition_by, atomic=atomic, slots=slots, verify=verify,
                                rebalance=rebalance)
    repeated = source.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"Merge source has several rows for one key {list(keys)}")
    if not exists(spark, table):
        return replace(spark, table, source, partition_by, verify=verify, rebalance=rebalance)
    target = read(spark, table)
    if sorted(c.lower() for c in source.columns) != sorted(c.lower() for c in target.columns):
        raise ValueError(f"Merge source columns do not match those of {table.sql}")
    source = source.select(*target.columns)
    parts = partition_columns(spark, table)
    if atomic or not parts:
        return replace(spark, table, upsert_rows(target, source, keys), parts, verify=verify)

    # Lists of partition values: as many as there are date partitions.
    arriving = source.select(*parts).distinct().collect()
    if set(parts) <= set(keys):
        _extend_indexes(spark, table, source)
        return overwrite_partitions(
            spark, table, upsert_rows(target.filter(_any_of(parts, arriving)), source, keys), indexed=True,
            rebalance=rebalance or len(arriving) > 1, verify=verify)
    # Only key and partition columns are read, and only of partitions that the index names.
    maybe = holding(spark, table, source, keys, slots)
    matched = (
        target.filter(maybe).select(*dict.fromkeys([*keys, *parts])).join(source.select(*keys), list(keys), "left_semi")
        .groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows")).collect()
    )

    def place(row) -> tuple:
        return tuple(row[p] for p in parts)

    filled = {place(row) for row in arriving}
    left = {place(row): row for row in matched if place(row) not in filled}
    emptied = []
    if left:
        sizes = (target.filter(_any_of(parts, list(left.values())))
                 .groupBy(*parts).agg(F.count(F.lit(1)).alias("_rows")).collect())
        emptied = [row for row in sizes if row["_rows"] == left[place(row)]["_rows"]]
    old = target.filter(_any_of(parts, [*left.values(), *arriving]))
    _index(spark, table, keys, slots)
    _extend_indexes(spark, table, source)
    rows = overwrite_partitions(spark, table, upsert_rows(old, source, keys), indexed=True, verify=verify)
    for row in emptied:
        drop_partition(spark, table, {p: row[p] for p in parts})
    return rows


def drop_orphans(spark: SparkSession, database: str) -> list[str]:
    """Drop versions that no view names, left by jobs that died before publishing theirs.

    Not beside a running writer, whose version has no view yet.
    """
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    versions = {name for name in names if re.search(r"__[0-9a-f]{16}$", name)}
    for name in set(names) - versions:
        notes = properties(spark, TableName(database, name))
        versions -= {notes.get(_CURRENT), notes.get(_PREVIOUS)}
    for name in sorted(versions):
        spark.sql(f"DROP TABLE IF EXISTS {TableName(database, name).sql}")
    return sorted(versions)


def latest_partition(spark: SparkSession, table: TableName, column: str, before) -> object:
    """Largest date partition before a day, from the catalog: no data file is opened."""
    found = spark.sql(f"SHOW PARTITIONS {physical(spark, table).sql}")
    value = F.regexp_extract("partition", f"(?:^|/){column}=([^/]+)", 1)
    day = F.to_date(F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")))
    return found.select(day.alias("d")).filter(F.col("d") < F.lit(before)).agg(F.max("d")).first()[0]
