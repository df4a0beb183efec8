"""Watchlists, explicit id lists and the instrument master."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Segments, symbol characters, limits and master columns.
SEGMENTS = ("IDX_I", "NSE_CURRENCY", "NSE_EQ", "NSE_FNO")
DEFAULT_SEGMENT = "NSE_EQ"
SYMBOL = r"^[A-Z0-9&_. /()\-]+$"
SYMBOL_LENGTH = 128
WATCHLIST_BYTES = 1024 * 1024
MASTER_COLUMNS = (
    "SEM_EXM_EXCH_ID", "SEM_SEGMENT", "SEM_SMST_SECURITY_ID", "SEM_INSTRUMENT_NAME",
    "SEM_TRADING_SYMBOL", "SEM_SERIES", "SEM_EXPIRY_DATE",
)


def _items(spark: SparkSession, text: str) -> DataFrame:
    return spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("position", "item"))


def _first_of_each(parsed: DataFrame, name: str, limit: int, what: str) -> DataFrame:
    """Reject bad items, drop repeats (the first stays) and check the limit."""
    bad = parsed.filter("NOT valid").orderBy("position").limit(10).collect()
    if bad:
        raise ValueError(f"Invalid {what}: {[row['item'] for row in bad]}")
    kept = parsed.groupBy("exchange_segment", name).agg(F.min("position").alias("position"))
    if not 0 < kept.limit(limit + 1).count() <= limit:
        raise ValueError(f"Between 1 and {limit} {what} are needed")
    return kept.select("position", "exchange_segment", name).orderBy("position")


def _symbol_requests(items: DataFrame, limit: int) -> DataFrame:
    parts = F.split(F.upper(F.trim("item")), ":")
    prefixed = F.size(parts) > 1
    segment = F.when(prefixed, F.trim(parts[0])).otherwise(DEFAULT_SEGMENT)
    symbol = F.trim(F.when(prefixed, F.get(parts, F.lit(1))).otherwise(parts[0]))
    valid = (
        (F.size(parts) <= 2) & segment.isin(*SEGMENTS)
        & symbol.rlike(SYMBOL) & (F.length(symbol) <= SYMBOL_LENGTH)
    )
    return _first_of_each(
        items.select("position", "item", segment.alias("exchange_segment"),
                     symbol.alias("symbol"), valid.alias("valid")),
        "symbol", limit, "symbols")


def parse_symbols(spark: SparkSession, text: str, max_instruments: int = 5000) -> DataFrame:
    """``SYMBOL`` or ``SEGMENT:SYMBOL`` entries to ``(position, exchange_segment, symbol)``."""
    if max_instruments < 1 or len(text) > max_instruments * (SYMBOL_LENGTH + 16):
        raise ValueError("The symbol list is longer than the instrument limit allows")
    return _symbol_requests(_items(spark, text), max_instruments)


def read_watchlist(spark: SparkSession, path: str, max_instruments: int = 1000) -> DataFrame:
    """A CSV file of at most 1 MiB with the single column ``symbol``; blank lines are skipped."""
    files = spark.read.format("binaryFile").load(path)
    size = files.agg(F.sum("length")).first()[0]
    if not size or size > WATCHLIST_BYTES:
        raise ValueError("The watchlist must have between 1 byte and 1 MiB")
    text = F.regexp_replace(F.decode("content", "UTF-8"), "^﻿", "")
    lines = files.select(F.posexplode(F.split(text, r"\r\n|\n|\r")).alias("position", "line"))
    cells = lines.filter("line <> ''").select(
        "position", F.from_csv("line", "item string, more string", {"mode": "PERMISSIVE"}).alias("c"),
    ).select("position", F.coalesce(F.trim("c.item"), F.lit("")).alias("item"),
             (F.col("c.more").isNotNull() | F.contains("c.item", F.lit(","))).alias("wide"))
    header = cells.orderBy("position").first()
    if header is None or header["wide"] or header["item"].lower() != "symbol":
        raise ValueError("The watchlist must have the single header 'symbol'")
    rows = cells.filter(F.col("position") > header["position"])
    if not rows.filter(F.col("wide") | (F.col("item") == "")).isEmpty():
        raise ValueError("Every watchlist line must hold one symbol")
    return _symbol_requests(rows.select("position", "item"), max_instruments)


def canonical_id(text: Column) -> Column:
    """Digits without leading zeros; null when there is no positive number."""
    digits = F.trim(text)
    return F.nullif(F.when(digits.rlike(r"^[0-9]+$"), F.regexp_replace(digits, "^0+", "")), F.lit(""))


def parse_instruments(spark: SparkSession, text: str, max_instruments: int = 5000) -> DataFrame:
    """``SEGMENT:ID`` entries to ``(position, exchange_segment, security_id)``."""
    parts = F.split("item", ":")
    segment, number = F.upper(F.trim(parts[0])), canonical_id(F.get(parts, F.lit(1)))
    valid = (F.size(parts) == 2) & segment.isin(*SEGMENTS) & number.isNotNull()
    return _first_of_each(
        _items(spark, text).select("position", "item", segment.alias("exchange_segment"),
                                   number.alias("security_id"), valid.alias("valid")),
        "security_id", max_instruments, "instruments")


def read_master(spark: SparkSession, path: str) -> DataFrame:
    """The instrument master as text columns. A ragged row fails the scan."""
    first = spark.read.text(path).limit(1).collect()
    names = [name.strip().strip('"') for name in first[0][0].lstrip("﻿").split(",")] if first else []
    repeated = sorted(name for name, n in Counter(names).items() if n > 1)
    absent = sorted(set(MASTER_COLUMNS) - set(names))
    if absent or repeated:
        raise ValueError(f"Instrument master: missing columns {absent}, repeated columns {repeated}")
    master = (
        spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
        .option("columnPruning", False).option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    )
    if master.isEmpty():
        raise ValueError("The instrument master has no rows")
    return master
