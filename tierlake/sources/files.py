"""File scans: format by extension, globs, and files named after their date."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tierlake.contract import Contract
from tierlake.names import run_day
from tierlake.session import workspace

# Date tokens of a path pattern, longest first, and their strftime formats.
DATE_TOKENS = {
    "YYYY-MM-DD": "%Y-%m-%d", "DD-MM-YYYY": "%d-%m-%Y", "MM-DD-YYYY": "%m-%d-%Y",
    "YYYY_MM_DD": "%Y_%m_%d", "DD_MM_YYYY": "%d_%m_%Y", "MM_DD_YYYY": "%m_%d_%Y",
    "YYYYMMDD": "%Y%m%d", "DDMMYYYY": "%d%m%Y",
}
# Date formats looked for when a pattern has "__" but no token.
LISTED_FORMATS = ("%Y-%m-%d", "%Y_%m_%d", "%Y%m%d", "%d-%m-%Y", "%d_%m_%Y")

FORMATS = ("csv", "json", "parquet")

# What the columns of CSV files may be without a contract, tried in this order; else they are text.
INFERRED = ("int", "bigint", "double", "date", "timestamp", "boolean")
# What a date and a number look like: a cast takes longer texts for dates too, and is slow to refuse a number.
_LOOKS = {"date": r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$",
          "double": r"^\s*([+-]?(\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?|NaN|-?Infinity)\s*$"}

# Bytes of paths and heads that may be broadcast.
_SMALL = 32 << 20


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or any match of a glob is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, modificationTime, length)`` of a file, folder or glob; no content is read."""
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime", "length")


def newest_file(files: DataFrame) -> str | None:
    """Path of the last modified file; of equally old ones the last by name."""
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def _candidates(pattern: str, day) -> list[str]:
    """What a pattern may mean for a day, in the order in which it is tried."""
    tokens = [(token, day.strftime(form)) for token, form in DATE_TOKENS.items()]
    if re.search(r"[*?\[]", pattern):
        for token, text in tokens:
            pattern = pattern.replace(token, text)
        return [pattern]
    marked = [pattern.replace(f"__{token}", f"__{text}") for token, text in tokens if f"__{token}" in pattern]
    # The longest token is the one meant: YYYY-MM-DD is listed before its parts.
    return [pattern, *marked[:1]]


def _newest_dated(spark: SparkSession, pattern: str, day) -> str | None:
    """The newest of the files ``<prefix>__<date>.*`` with the day in a listed format."""
    prefix, separator, _ = pattern.rpartition("__")
    if not separator or not exists(spark, f"{prefix}__*"):
        return None
    forms = [re.escape(day.strftime(form)) for form in LISTED_FORMATS]
    name = re.escape(prefix.rpartition("/")[2])
    wanted = f"(^|/){name}__({'|'.join(forms)})([.][^/]*)?$"
    return newest_file(list_files(spark, f"{prefix}__*").filter(F.col("path").rlike(wanted)))


def resolve_dated_file(spark: SparkSession, pattern: str, day: str) -> str:
    """The file, or the glob, that ``pattern`` means for a day.

    Tried in turn: the pattern as it stands (a glob with its date tokens filled in), the
    pattern with the token after ``__`` filled in, and, for a ``__`` without a token, the
    newest file whose date part is the day in any listed format.
    """
    day = run_day(day)
    tried = _candidates(pattern, day)
    for path in tried:
        if exists(spark, path):
            return path
    found = _newest_dated(spark, pattern, day) if len(tried) == 1 and "*" not in pattern else None
    if found is None:
        raise FileNotFoundError(f"No input for {day}: looked for {', '.join(tried)}")
    return found


def file_format(path: str) -> str:
    """The format that a file's extension stands for."""
    ending = path[path.rfind(".") + 1:].lower()
    if ending in FORMATS:
        return ending
    raise ValueError(f"{path!r} ends in {ending!r}; files of {', '.join(FORMATS)} can be read")


def _read_json(spark: SparkSession, path: str, contract: Contract | None, strict: bool) -> DataFrame:
    lines = spark.read.option("mode", "FAILFAST")
    if contract is None:
        return lines.json(path)
    schema = contract.json_schema()
    if not strict:
        return lines.schema(schema).json(path)
    lines = spark.read.option("singleVariantColumn", "_line").json(path)
    names = F.map_keys(F.try_variant_get("_line", "$", "map<string,variant>"))
    extra = F.array_except(names, F.array(*(F.lit(name) for name in contract.names)))
    fault = F.when(names.isNull(), F.lit("A line is no JSON object")).when(
        F.size(extra) > 0, F.concat(F.lit("Fields that the contract does not declare: "), F.concat_ws(", ", extra)))
    known = lines.filter(F.when(fault.isNull(), True).otherwise(F.raise_error(fault).cast("boolean")))
    kinds = ", ".join(f"`{field.name}`: {field.dataType.simpleString()}" for field in schema)
    return known.select(F.variant_get("_line", "$", f"struct<{kinds}>").alias("_row")).select("_row.*")


def _heads(spark: SparkSession, path: str) -> DataFrame:
    """``(_file, _head)``: the first line with text of every file, from one pass over the lines, written once."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    # The ids of a task rise along a file, so the first line of its first block has the least.
    first = lines.filter("block = 0 AND trim(value) <> ''").groupBy("_file").agg(F.min_by("value", "place").alias("_head"))
    place = workspace(spark, "heads")
    first.write.parquet(place)
    return spark.read.parquet(place)


class CsvFiles:
    """The CSV files of a path, read by the names in their own headers.

    ``names`` are those of a contract, else of the first file. If there are several files, a pass over
    their lines finds the heads; ``one_header`` says that all are alike and spares it. Files with
    one and the same header are then scanned as they are; otherwise each row is joined with the head of
    its file. The driver sees how many headers there are and one that is wrong, but no list of files.
    """

    def __init__(self, spark: SparkSession, path: str, names: Sequence[str] | None = None, one_header: bool = False) -> None:
        self.spark, self.path = spark, path
        self.first = self.reader().csv(path).columns
        self.names = list(names or self.first)
        self.heads = None
        if one_header or _one_file(spark, path):
            return
        heads = _heads(spark, path)
        kinds = heads.groupBy("_head").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_file")).alias("size"))
        known = kinds.withColumn("_order", self._order()).withColumn(
            "wrong", F.array_sort("_order") != F.array(*(F.lit(name) for name in sorted(self.names))))
        seen = known.agg(
            F.count(F.lit(1)).alias("kinds"), F.sum(F.col("size") + F.col("n") * F.octet_length("_head")).alias("size"),
            F.min(F.when(F.col("wrong"), F.array_join("_order", ", "))).alias("wrong")).first()
        if (seen["kinds"] or 0) < 2:
            return
        if seen["wrong"] is not None:
            raise ValueError(f"A file has the columns {seen['wrong']}, where {', '.join(self.names)} are expected")
        self.heads = heads.select("_file", self._order().alias("_order"))
        if seen["size"] <= _SMALL:
            self.heads = F.broadcast(self.heads)

    def _order(self) -> Column:
        """The names in a head, one more than expected included."""
        cells = ", ".join(f"_{i} string" for i in range(len(self.names) + 1))
        head = F.from_csv("_head", cells)
        return F.array_compact(F.array(*(head[f"_{i}"] for i in range(len(self.names) + 1))))

    def reader(self, **options) -> DataFrameReader:
        return self.spark.read.options(header=True, recursiveFileLookup=True, **options)

    def rows(self, reader: DataFrameReader, extra: Sequence[str] = ()) -> DataFrame:
        """Cells as text by name, with the ``extra`` columns of a reader and the ``_file`` of a row."""
        names = self.first if self.heads is None else [f"_{i}" for i in range(len(self.names))]
        schema = ", ".join(f"`{name}` string" for name in [*names, *extra])
        rows = reader.schema(schema).csv(self.path).withColumn("_file", F.col("_metadata.file_path"))
        if self.heads is None:
            return rows
        cells = rows.select(F.array(*names).alias("_cells"), *extra, "_file").join(self.heads, "_file")
        return cells.select(*(F.get("_cells", (F.array_position("_order", F.lit(name)) - 1).cast("int")).alias(name)
                              for name in self.names), *extra, "_file")


def _one_file(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return len(found) == 1 and found[0].isFile()


def _inferred(df: DataFrame) -> DataFrame:
    """Text columns as the first type that all their values have; one aggregate over the rows."""
    def fits(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        looks = value.rlike(_LOOKS[kind]) if kind in _LOOKS else F.lit(True)
        return F.every(value.isNull() | F.when(looks, value.try_cast(kind).isNotNull()).otherwise(False))

    seen = df.agg(*(F.struct(F.count(f"`{name}`").alias("n"), *(fits(name, kind).alias(kind) for kind in INFERRED)).alias(f"c{i}")
                    for i, name in enumerate(df.columns))).first()
    kinds = [next((kind for kind in INFERRED if seen[i]["n"] and seen[i][kind]), "string") for i in range(len(df.columns))]
    return df.select(*(F.col(f"`{name}`").cast(kind).alias(name) for name, kind in zip(df.columns, kinds)))


def _read_csv(spark: SparkSession, path: str, contract: Contract | None, one_header: bool) -> DataFrame:
    """Columns by name, whatever their order in a file; a row with a cell too many or too few fails the job."""
    files = CsvFiles(spark, path, contract and contract.names, one_header)
    # The head of a file is compared with the schema where the schema has its names.
    strict = files.reader(mode="FAILFAST", enforceSchema=files.heads is not None)
    if files.heads is not None:
        rows = files.rows(strict).drop("_file")
        return rows if contract is not None else _inferred(rows)
    if contract is not None:
        return files.rows(strict).drop("_file")
    return strict.schema(files.reader(inferSchema=True).csv(path).schema).csv(path)


def read_files(spark: SparkSession, path: str, contract: Contract | None = None, *,
               strict: bool = True, one_header: bool = False) -> DataFrame:
    """Scan CSV, JSON lines or Parquet, chosen by extension.

    Without a contract CSV and JSON types are inferred, which is a pass of its own over
    the data. With a contract there is one pass, and the cast follows: CSV columns come as
    text; JSON fields come as text or VARIANT, and a line with a field outside the contract
    fails the job. ``strict=False`` ignores such fields and is faster. A contract field that no
    line has is null. A line that is no JSON object, and a CSV row that is longer or shorter
    than its header, fail the job; CSV files with other orders of columns are read by name. To learn
    of such orders costs a pass over the lines; ``one_header`` spares it, and a file with another
    header then fails the job.
    """
    kind = file_format(path)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if kind == "csv":
        return _read_csv(spark, path, contract, one_header)
    if kind == "json":
        return _read_json(spark, path, contract, strict)
    return spark.read.parquet(path)
