"""Active instruments of a master, and the lookup of requested symbols in it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.names import run_day
from tierlake.sources.instruments import canonical_id

# Derivative instrument names by master segment.
EQUITY_DERIVATIVES = ("FUTSTK", "FUTIDX", "OPTSTK", "OPTIDX")
CURRENCY_DERIVATIVES = ("FUTCUR", "OPTCUR")


def classify_instruments(master: DataFrame, trading_day: str | date) -> DataFrame:
    """Add ``exchange_segment`` and keep the rows that have one, i.e. are active.

    Derivatives count until their expiry day; an unreadable expiry does not count.
    """
    def code(name: str):
        return F.upper(F.trim(F.coalesce(F.col(name), F.lit(""))))

    segment, kind = code("SEM_SEGMENT"), code("SEM_INSTRUMENT_NAME")
    expiry = F.to_date(F.trim("SEM_EXPIRY_DATE").try_cast("timestamp"))
    live = expiry >= F.lit(run_day(trading_day))
    return master.filter(code("SEM_EXM_EXCH_ID") == "NSE").withColumn(
        "exchange_segment",
        F.when((segment == "E") & (kind == "EQUITY") & (code("SEM_SERIES") == "EQ"), "NSE_EQ")
        .when((segment == "I") & (kind == "INDEX"), "IDX_I")
        .when((segment == "D") & kind.isin(*EQUITY_DERIVATIVES) & live, "NSE_FNO")
        .when((segment == "C") & kind.isin(*CURRENCY_DERIVATIVES) & live, "NSE_CURRENCY"),
    ).filter(F.col("exchange_segment").isNotNull())


def lookup_names(active: DataFrame) -> DataFrame:
    """``(exchange_segment, symbol, first_id, last_id)``: the ids behind each exact name.

    Indices also answer to their display name. Ids are reduced to a smallest and a largest
    one, so nothing is collected for a name that occurs very often.
    """
    def name(column: str):
        return F.nullif(F.upper(F.trim(column)), F.lit(""))

    names = [name("SEM_TRADING_SYMBOL")]
    if "SEM_CUSTOM_SYMBOL" in active.columns:
        names.append(F.when(F.col("exchange_segment") == "IDX_I", name("SEM_CUSTOM_SYMBOL")))
    listed = active.select(
        "exchange_segment", canonical_id(F.col("SEM_SMST_SECURITY_ID")).alias("id"),
        F.explode(F.array_distinct(F.array_compact(F.array(*names)))).alias("symbol"),
    ).filter("id IS NOT NULL")
    return listed.groupBy("exchange_segment", "symbol").agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def match_instruments(requests: DataFrame, master: DataFrame, trading_day: str | date) -> DataFrame:
    """Requests ``(exchange_segment, symbol)`` with ``security_id`` and ``status``.

    Status is ``resolved``, ``unknown`` (no active instrument of that name) or ``ambiguous``
    (several ids for the name, or one id for several requests).
    """
    names = lookup_names(classify_instruments(master, trading_day))
    found = requests.join(names, ["exchange_segment", "symbol"], "left").withColumn(
        "security_id", F.when(F.col("first_id") == F.col("last_id"), F.col("first_id")))
    shared = (
        found.filter("security_id IS NOT NULL").groupBy("exchange_segment", "security_id")
        .agg(F.count(F.lit(1)).alias("_requests")).filter("_requests > 1")
    )
    status = (
        F.when(F.col("first_id").isNull(), "unknown")
        .when(F.col("security_id").isNull() | F.col("_requests").isNotNull(), "ambiguous")
        .otherwise("resolved")
    )
    return found.join(shared, ["exchange_segment", "security_id"], "left").select(
        *requests.columns, F.when(status == "resolved", F.col("security_id")).alias("security_id"),
        status.alias("status"))


def resolve_instruments(requests: DataFrame, master: DataFrame,
                        trading_day: str | date) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(resolved, unknown, ambiguous)``."""
    matched = match_instruments(requests, master, trading_day)
    return tuple(
        matched.filter(F.col("status") == status).drop("status")
        for status in ("resolved", "unknown", "ambiguous"))
