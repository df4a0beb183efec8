"""Row predicates: snapshot dates, date scopes, mapper filters, empty-input gate."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.names import run_day

# Comparison operators a mapper filter may use.
OPERATORS = ("=", "<>", "!=", "<", "<=", ">", ">=", "LIKE", "NOT LIKE")
NULL_TESTS = ("IS NULL", "IS NOT NULL")

_BARE_NUMBER = re.compile(r"-*(\d+\.?\d*|\.\d+)")


def day_literal(day: str | date | None) -> Column:
    """The given day, or today in the session time zone."""
    return F.current_date() if day is None else F.lit(run_day(day))


def on_date(df: DataFrame, column: str, day: str | date | None = None) -> DataFrame:
    """Rows of one day. The bare partition column is compared, so the scan is pruned."""
    return df.filter(F.col(column) == day_literal(day))


def date_scope(df: DataFrame, column: str, day: str | date, keep: bool = False) -> DataFrame:
    """Rows of ``day``, or with ``keep`` the rows of every other day and of no day.

    A timestamp is compared with a half-open range rather than cast to a date, which
    keeps the predicate in the Parquet scan.
    """
    day = run_day(day)
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, T.DateType):
        inside, outside = value == F.lit(day), value != F.lit(day)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        start, end = (F.lit(d).cast(kind) for d in (day, day + timedelta(days=1)))
        inside, outside = (value >= start) & (value < end), (value < start) | (value >= end)
    else:
        raise ValueError(f"{column!r} must be a DATE or TIMESTAMP column")
    return df.filter(value.isNull() | outside) if keep else df.filter(inside)


def _literal(text: str) -> str:
    """SQL text of a filter value: quoted texts and numbers as they are, anything else as a text."""
    if text[0] == "'" or _BARE_NUMBER.fullmatch(text):
        return text
    return "'" + text.translate(str.maketrans({"\\": r"\\", "'": r"\'"})) + "'"


def filter_expression(item: Mapping[str, str]) -> Column | None:
    """One ``{col, op, val}`` entry; ``None`` when it has no column or no value."""
    column, operator, value = (str(item.get(part) or "").strip() for part in ("col", "op", "val"))
    operator = re.sub(r"\s+", " ", operator).upper() or "="
    if operator not in OPERATORS + NULL_TESTS:
        raise ValueError(f"A filter cannot use {operator!r} as its operator")
    if not column or not (value or operator in NULL_TESTS):
        return None
    operand = "" if operator in NULL_TESTS else _literal(value)
    return F.expr(f"({column}) {operator} {operand}")


def apply_filters(df: DataFrame, filters: Iterable[Mapping[str, str]]) -> DataFrame:
    conditions = [c for c in map(filter_expression, filters) if c is not None]
    return reduce(DataFrame.filter, conditions, df)


def require_rows(df: DataFrame, message: str) -> None:
    """Stop before anything is published when there is no input row (a limit-1 job)."""
    if df.isEmpty():
        raise ValueError(message)
