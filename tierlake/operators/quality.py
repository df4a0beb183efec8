"""Data tests of a table and reconciliation between two layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_tests(df: DataFrame, tests: Sequence[Mapping]) -> DataFrame:
    """Result rows ``(test, column, violations)``.

    A test is ``{"test": "not_null", "column": c}``, ``{"test": "accepted_values",
    "column": c, "values": [...]}``, ``{"test": "unique", "column": c}`` or
    ``{"test": "unique_combination", "columns": [...]}``. All row tests share one scan and
    one aggregate; each uniqueness test is one partially aggregated group count. As usual
    for such tests, ``unique`` ignores nulls and counts the repeated values.
    """
    row_tests, results = [], []
    for test in tests:
        kind = test["test"]
        if kind == "not_null":
            row_tests.append((kind, test["column"], F.col(test["column"]).isNull()))
        elif kind == "accepted_values":
            value = F.col(test["column"])
            row_tests.append((kind, test["column"], value.isNotNull() & ~value.isin(*test["values"])))
        elif kind in ("unique", "unique_combination"):
            columns = [test["column"]] if kind == "unique" else list(test["columns"])
            rows = df.dropna(subset=columns) if kind == "unique" else df
            repeated = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
            results.append(repeated.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(kind).alias("test"), F.lit(",".join(columns)).alias("column"), "violations"))
        else:
            raise ValueError(f"Unknown test: {kind!r}")
    if row_tests:
        counts = df.agg(*(F.count_if(bad).alias(f"n{i}") for i, (_, _, bad) in enumerate(row_tests)))
        results.insert(0, counts.select(F.inline(F.array(*(
            F.struct(F.lit(kind).alias("test"), F.lit(column).alias("column"),
                     F.col(f"n{i}").alias("violations"))
            for i, (kind, column, _) in enumerate(row_tests))))))
    if not results:
        raise ValueError("No tests given")
    report = results[0]
    for part in results[1:]:
        report = report.unionByName(part)
    return report


def require_passing(report: DataFrame) -> None:
    """Fail on any violation. The report has one row per test."""
    failed = report.filter("violations > 0").collect()
    if failed:
        raise ValueError("Data tests failed: " + ", ".join(
            f"{row['test']}({row['column']}): {row['violations']}" for row in failed))


def duplicate_names(sheet: DataFrame, column: str) -> DataFrame:
    """Names that occur more than once, ignoring case and outer blanks."""
    name = F.lower(F.trim(column)).alias("name")
    names = sheet.dropna(subset=[column]).groupBy(name)
    return names.agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def profile(df: DataFrame, keys: Sequence[str] = (), measures: Sequence[str] = ()) -> DataFrame:
    """One row: row count, distinct keys, and sum and null count of every measure.

    Sums are taken as decimals so that they do not depend on the order of the rows. The
    distinct keys come from their own partially aggregated pass over the key columns.
    """
    totals = [F.count(F.lit(1)).alias("rows")]
    for name in measures:
        value = F.col(f"`{name}`")
        totals.append(F.sum(value.cast("decimal(28,6)")).alias(f"sum_{name}"))
        totals.append(F.count_if(value.isNull()).alias(f"nulls_{name}"))
    if keys:
        totals.append(F.count_distinct(F.struct(*keys)).alias("keys"))
    return df.agg(*totals)


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
              measures: Sequence[str] = ()) -> DataFrame:
    """Rows ``(measure, left_value, right_value, matches)`` for two layers of one dataset."""
    def tall(df: DataFrame, value: str) -> DataFrame:
        one = profile(df, keys, measures)
        return one.select(F.inline(F.array(*(
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("decimal(38,6)").alias(value))
            for c in one.columns))))

    return tall(left, "left_value").join(tall(right, "right_value"), "measure").withColumn(
        "matches", F.col("left_value").eqNullSafe(F.col("right_value")))
