"""Source to Lake with faulty rows set apart, each with its file, its reason and the cells at fault.

Reasons: ``ragged`` (a CSV row longer or shorter than its header), ``unparsable`` and ``undeclared: ...`` (a JSON line),
``uncastable`` (a cell that its contract type refuses; all such cells of a row are listed). A file whose header does not
follow the contract still fails the job, as every row of it would be at fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake import tables
from tierlake.contract import Contract
from tierlake.functions.privacy import Keys
from tierlake.names import Layers, identifier, job_name, run_day
from tierlake.plans.lake import ingest
from tierlake.sources.files import CsvFiles, exists, file_format
from tierlake.streaming.ingest import tag_lines

_TAGS = ("_line", "_reason", "_file")


def _tag_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    files = CsvFiles(spark, path, contract.names)
    if files.heads is None:
        contract.check(spark.createDataFrame([], ", ".join(f"`{name}` string" for name in files.first)))
    # Without pruning a row is judged by all its cells, whatever columns are asked for.
    lines = files.rows(files.reader(mode="PERMISSIVE", columnPruning=False, columnNameOfCorruptRecord="_line"), ["_line"])
    reason = F.when(F.col("_line").isNotNull(), "ragged").alias("_reason")
    return lines.select(*contract.names, "_line", reason, "_file")


def tag_rows(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Rows of CSV or JSON files as text, with ``_line``, ``_reason`` (null: none), ``_file`` and ``_faults``.

    ``_faults`` is an array of ``(column, value)``: the cells that a cast would refuse.
    """
    if not exists(spark, path):
        raise FileNotFoundError(path)
    kind = file_format(path)
    if kind == "csv":
        rows = _tag_csv(spark, path, contract)
    elif kind == "json":
        rows = tag_lines(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")), contract)
    else:
        raise ValueError("Parquet files have types and no faulty rows; read them with read_files")
    return rows.withColumn("_faults", _faults(contract)).withColumn(
        "_reason", F.coalesce("_reason", F.when(F.size("_faults") > 0, "uncastable")))


def _faults(contract: Contract) -> Column:
    """All refused cells of a row that has its cells in the right places."""
    cells = []
    for field in contract.fields:
        value = F.col(f"`{field.name}`")
        refused = value.isNotNull() & value.try_cast(contract.data_type(field)).isNull()
        cells.append(F.when(refused, F.struct(F.lit(field.name).alias("column"), value.alias("value"))))
    found = F.array_compact(F.array(*cells))
    return F.when(F.col("_reason").isNull(), found).otherwise(F.slice(found, 1, 0))


def split_rows(tagged: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(good, faulty)`` of tagged rows: contract columns as text, and ``(file, reason, faults, row)``.

    ``row`` is the line as it came, of an uncastable CSV row its cells as JSON. If the contract protects a column,
    no ``row`` is kept and no value of a protected column, so nothing protected is written in clear.
    """
    good = tagged.filter(F.col("_reason").isNull()).select(*contract.names)
    secret = [field.name for field in contract.fields if field.level not in ("none", "", None)]
    line = F.coalesce("_line", F.to_json(F.struct(*(f"`{name}`" for name in contract.names))))
    faults = F.col("_faults")
    if secret:
        line = F.lit(None).cast("string")
        faults = F.transform(faults, lambda cell: F.struct(
            cell["column"].alias("column"), F.when(~cell["column"].isin(*secret), cell["value"]).alias("value")))
    bad = tagged.filter(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), faults.alias("faults"), line.alias("row"))
    return good, bad


def ingest_checked(spark: SparkSession, layers: Layers, app: str, path: str, contract: Contract, ingest_date: str,
                   mode: str = "overwrite", keys: Keys = Keys()) -> tuple[int, int]:
    """Good rows to the Lake table ``app``, faulty ones to ``<app>_quarantine``. Returns both counts.

    Both tables hold one state per date after a run that is repeated, also when its files have been mended
    since; in mode ``append`` faulty rows are added too. The files are scanned once for each table. Faulty
    rows are written first, so they are there to look at if no row is good and the Lake refuses.
    """
    good, bad = split_rows(tag_rows(spark, path, contract), contract)
    layers.ensure(spark, "lake")
    table = layers.resolve(job_name(identifier(f"{app}_quarantine")), "lake")
    dated = bad.withColumn("ingest_date", F.lit(run_day(ingest_date)))
    if not tables.exists(spark, table):
        faulty = tables.replace(spark, table, dated, ["ingest_date"], allow_empty=True, rebalance=False)
    elif mode == "append":
        faulty = tables.append(spark, table, dated)
    else:
        faulty = tables.overwrite_partitions(spark, table, dated, rebalance=False)
        if faulty == 0:
            # Nothing to overwrite with: what an earlier run has set apart is mended.
            tables.drop_partition(spark, table, {"ingest_date": run_day(ingest_date)})
    return ingest(spark, layers, app, good, contract, ingest_date, mode, keys), faulty
