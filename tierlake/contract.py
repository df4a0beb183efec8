"""The column contract: a CSV sheet with one row per column of a dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Contract type name -> Spark type.
TYPES = {
    "string": T.StringType(), "str": T.StringType(), "varchar": T.StringType(),
    "text": T.StringType(), "char": T.StringType(),
    "integer": T.IntegerType(), "int": T.IntegerType(), "smallint": T.IntegerType(),
    "bigint": T.LongType(), "long": T.LongType(),
    "double": T.DoubleType(), "numeric": T.DoubleType(),
    "float": T.FloatType(), "real": T.FloatType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(), "datetime": T.TimestampType(),
}

# Protection levels of a column.
LEVELS = ("none", "", "hash", "pii", "mask")

# Flags that mean yes in primary_key and is_timestamp.
YES = ("y", "yes", "true", "1")


@dataclass(frozen=True)
class Field:
    name: str
    datatype: str
    level: str = "none"
    length: int | None = None
    precision: int | None = None
    key: bool = False
    time: bool = False


@dataclass(frozen=True)
class Contract:
    """Column definitions in sheet order. Its size is bounded by the column count."""

    fields: tuple[Field, ...]
    has_sizes: bool = False

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Contract":
        """Read the sheet as text; nothing is inferred."""
        return cls.from_frame(spark.read.option("header", True).csv(path))

    @classmethod
    def from_frame(cls, sheet: DataFrame) -> "Contract":
        for needed in ("column_name", "datatype"):
            if needed not in sheet.columns:
                raise ValueError(f"The contract sheet has no column {needed!r}")

        def text(name: str, default: str | None = None) -> Column:
            if name not in sheet.columns:
                return F.lit(default).cast("string")
            return F.trim(F.coalesce(F.col(name).cast("string"), F.lit(default)))

        def size(name: str) -> Column:
            # Spreadsheet tools write whole numbers as 18.0 now and then.
            return F.nullif(text(name), F.lit("")).cast("double").cast("int")

        rows = sheet.select(
            F.coalesce(text("column_name"), F.lit("")).alias("name"),
            F.lower(text("datatype")).alias("datatype"),
            F.lower(text("security_level", "none")).alias("level"),
            size("data_length").alias("length"),
            size("data_precision").alias("precision"),
            F.coalesce(F.lower(text("primary_key")).isin(*YES), F.lit(False)).alias("key"),
            F.coalesce(F.lower(text("is_timestamp")).isin(*YES), F.lit(False)).alias("time"),
        ).collect()
        seen: set[str] = set()
        for number, row in enumerate(rows, 1):
            if not row["name"]:
                raise ValueError(f"Row {number} of the contract sheet names no column")
            if row["name"].casefold() in seen:
                raise ValueError(f"Row {number} of the contract sheet defines {row['name']!r} again")
            seen.add(row["name"].casefold())
            if row["level"] not in LEVELS:
                # A typing error here would publish the column in clear.
                raise ValueError(f"Column {row['name']!r} has an unknown security level {row['level']!r}")
        return cls(
            tuple(Field(**row.asDict()) for row in rows),
            {"data_length", "data_precision"} <= set(sheet.columns),
        )

    @property
    def names(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def keys(self) -> list[str]:
        return [field.name for field in self.fields if field.key]

    @property
    def order_by(self) -> str | None:
        return next((field.name for field in self.fields if field.time), None)

    def data_type(self, field: Field) -> T.DataType:
        if field.datatype == "decimal" and self.has_sizes:
            if field.length is None or field.precision is None:
                return T.DoubleType()
            # The sheet calls the precision "length" and the scale "precision".
            return T.DecimalType(field.length, field.precision)
        if field.datatype not in TYPES:
            raise ValueError(f"Column {field.name!r} has the unknown type {field.datatype!r}")
        return TYPES[field.datatype]

    def text_schema(self) -> T.StructType:
        """All columns as text, for sources that need a schema before the cast."""
        return T.StructType([T.StructField(name, T.StringType()) for name in self.names])

    def json_schema(self) -> T.StructType:
        """Text columns as text, others as VARIANT, which keeps 12.0 apart from "12.0"."""
        return T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(self.data_type(f), T.StringType) else T.VariantType())
            for f in self.fields
        ])

    def check(self, df: DataFrame) -> None:
        """The column sets must be equal, in the same case. Looks at the schema only."""
        declared, present = set(self.names), set(df.columns)
        spelling = {name.casefold(): name for name in declared}
        faults = []
        for name in sorted(present - declared):
            twin = spelling.pop(name.casefold(), None)
            faults.append(f"{name!r} must be written {twin!r}" if twin in declared - present else f"{name!r} is not declared")
        faults += [f"{name!r} is absent" for name in sorted(declared - present) if name.casefold() in spelling]
        if faults:
            raise ValueError("The columns do not follow the contract: " + "; ".join(faults))

    def _targets(self, df: DataFrame) -> dict[str, T.DataType]:
        present = set(df.columns)
        return {f.name: self.data_type(f) for f in self.fields if f.name in present}

    def cast(self, df: DataFrame) -> DataFrame:
        """Every contract column to its type in one projection; others pass through."""
        targets = self._targets(df)
        return df.select(
            *(F.col(f"`{c}`").cast(targets[c]).alias(c) if c in targets else F.col(f"`{c}`")
              for c in df.columns)
        )

    def cast_report(self, df: DataFrame) -> DataFrame:
        """Rows ``(column, datatype, failures)``: values that the cast would refuse."""
        targets = self._targets(df)
        counts = df.agg(*(
            F.count_if(_refused(name, kind)).alias(f"n{i}")
            for i, (name, kind) in enumerate(targets.items())
        ))
        return counts.select(F.inline(F.array(*(
            F.struct(F.lit(name).alias("column"), F.lit(kind.simpleString()).alias("datatype"),
                     F.col(f"n{i}").alias("failures"))
            for i, (name, kind) in enumerate(targets.items())
        ))))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(castable rows, cast), (rows with a refused value, as they came)."""
        bad = F.lit(False)
        for name, kind in self._targets(df).items():
            bad = bad | _refused(name, kind)
        return self.cast(df.filter(~bad)), df.filter(bad)


def _refused(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    return value.isNotNull() & value.try_cast(kind).isNull()
