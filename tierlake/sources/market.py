"""Market payloads as rows of one 28-column record.

Inputs are landed payload texts, so any number of responses is read in parallel. Fields
are read from VARIANT values inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.contract import Contract, Field
from tierlake.functions import market as m

# The columns of the market record and their types.
RECORD = {
    "source": "string", "batch_id": "string", "sequence": "bigint", "event_id": "string",
    "feed_type": "string", "exchange_segment": "string", "security_id": "string",
    "received_at": "timestamp", "trading_date": "date", "exchange_time": "timestamp",
    "last_price": "double", "last_quantity": "bigint", "average_price": "double",
    "volume": "bigint", "buy_quantity": "bigint", "sell_quantity": "bigint",
    "open": "double", "high": "double", "low": "double", "close": "double",
    "net_change": "double", "open_interest": "bigint", "previous_open_interest": "bigint",
    "oi_day_high": "bigint", "oi_day_low": "bigint",
    "upper_circuit_limit": "double", "lower_circuit_limit": "double", "depth_json": "string",
}

# Packet types of the live feed, and its segment codes.
FEED_TYPES = {
    "ticker data": "ticker", "quote data": "quote", "full data": "full",
    "oi data": "open_interest", "previous close": "previous_close",
}
SEGMENT_CODES = {0: "IDX_I", 1: "NSE_EQ", 2: "NSE_FNO", 3: "NSE_CURRENCY"}


# The fields of a quote and of a packet.
QUOTE = """struct<
    last_trade_time: string, last_price: double, last_quantity: bigint, average_price: double,
    volume: bigint, buy_quantity: bigint, sell_quantity: bigint, net_change: double,
    ohlc: struct<open: double, high: double, low: double, close: double>,
    oi: bigint, oi_day_high: bigint, oi_day_low: bigint,
    upper_circuit_limit: double, lower_circuit_limit: double, depth: variant>"""
PACKET = """struct<
    type: string, exchange_segment: bigint, security_id: bigint, LTT: string, LTP: double,
    LTQ: bigint, avg_price: double, volume: bigint, total_buy_quantity: bigint,
    total_sell_quantity: bigint, open: double, high: double, low: double, close: variant,
    prev_close: double, OI: bigint, prev_OI: bigint, oi_day_high: bigint, oi_day_low: bigint,
    depth: variant>"""


# Key columns of the two market contracts; both order by the time of receipt.
SNAPSHOT_KEY = ("exchange_segment", "security_id")
TICK_KEY = ("event_id",)


def market_contract(keys: Sequence[str]) -> Contract:
    """The contract of market records, with ``SNAPSHOT_KEY`` or ``TICK_KEY``."""
    return Contract(tuple(
        Field(name, kind, key=name in keys, time=name == "received_at") for name, kind in RECORD.items()))


def record(**values: Column) -> list[Column]:
    """The record's columns in order and type; what is not given is null."""
    return [
        values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in RECORD.items()
    ]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One payload per file: its text, the file as batch id, its time as time of receipt."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("value").alias("payload"),
                F.sha2(F.col("_metadata.file_path"), 256).alias("batch_id"),
                F.col("_metadata.file_modification_time").alias("received_at"))
    )


def flatten_snapshots(payloads: DataFrame, mode: str, source: str = "broker") -> DataFrame:
    """``(payload, batch_id, received_at)`` rows to one record per quoted instrument.

    A payload is ``{"status", "data": {segment: {id: quote}}}``. An unsuccessful payload, one
    without data or one without a quote fails the job. The sequence number counts a
    payload's quotes by segment and numeric id; the sort is inside the payload's row, so
    no shuffle is needed.
    """
    parsed = payloads.withColumn("_doc", F.try_parse_json("payload"))
    # No other letters than these become these in lower case.
    success = F.coalesce(m.fields("_doc", "$.status", "string"), F.lit("")).rlike(r"(?i)\Asuccess\z")
    data = m.fields("_doc", "$.data", f"map<string, map<string, {QUOTE}>>")
    parsed = parsed.withColumn("_data", F.when(success, data).otherwise(
        F.raise_error(F.lit("A snapshot payload reports no success"))))

    def quotes(segment: Column) -> Column:
        # The depth becomes text here: a struct with a VARIANT could not be sorted.
        return F.transform(
            F.filter(F.map_entries(segment["value"]), lambda e: e["value"].isNotNull()),
            lambda e: F.struct(
                segment["key"].alias("segment"), F.length(e["key"]).alias("size"), e["key"].alias("id"),
                e["value"].dropFields("depth").alias("q"), m.stable_json(e["value"]["depth"]).alias("depth")))

    segments = F.filter(F.map_entries("_data"), lambda e: e["value"].isNotNull())
    listed = parsed.select("batch_id", "received_at", F.when(
        F.col("_data").isNotNull(), F.sort_array(F.flatten(F.transform(segments, quotes))),
    ).otherwise(F.raise_error(F.lit("A snapshot payload holds no data object"))).alias("_quotes"))
    in_order = listed.select("batch_id", "received_at", F.when(
        F.size("_quotes") > 0, F.col("_quotes"),
    ).otherwise(F.raise_error(F.lit("A snapshot payload quotes no instrument"))).alias("_quotes"))
    # The outer form: for the plain one Spark infers a filter on the size of the array and
    # pushes it, with all that leads to the array, below the parser. No array is empty here.
    rows = in_order.select(
        "batch_id", "received_at", F.posexplode_outer("_quotes").alias("_at", "_quote"),
    ).select("batch_id", "received_at", (F.col("_at") + 1).alias("sequence"), "_quote.*")
    received = F.col("received_at")
    rows = rows.withColumn("_time", m.exchange_time(F.col("q.last_trade_time"), received, local=True))
    same_name = (
        "last_price", "last_quantity", "average_price", "volume", "buy_quantity", "sell_quantity",
        "net_change", "oi_day_high", "oi_day_low", "upper_circuit_limit", "lower_circuit_limit")
    return rows.select(*record(
        source=F.lit(source), batch_id=F.col("batch_id"), sequence=F.col("sequence"),
        event_id=m.event_id(F.col("batch_id"), F.col("segment"), F.col("id"), F.col("sequence")),
        feed_type=F.lit(mode), exchange_segment=F.col("segment"), security_id=F.col("id"),
        received_at=received, exchange_time=F.col("_time"),
        trading_date=m.trading_date(F.col("_time"), received),
        **{name: F.col(f"q.{name}") for name in same_name},
        **{name: F.col(f"q.ohlc.{name}") for name in ("open", "high", "low", "close")},
        open_interest=F.col("q.oi"), depth_json=F.col("depth"),
    ))


def _lookup(key: Column, table: dict) -> Column:
    # One use of the key: each branch of a CASE would compute it again.
    return F.try_element_at(F.create_map(*(F.lit(v) for pair in table.items() for v in pair)), key)


def tag_packets(packets: DataFrame, source: str = "broker") -> DataFrame:
    """``(payload, batch_id, sequence, received_at)`` rows to ``(reason, payload, record)`` rows.

    Packets of other types (control packets) are left out. A packet that is no JSON object,
    or of a known type without a valid segment code or security id, has a reason and no
    record. One pass: readers of both kinds should split what this has written.
    """
    # The one-element explode keeps the filters above the parser: pushed below it, each of
    # them would parse the payload once more.
    document = F.try_parse_json("payload")
    read = F.struct(m.fields(document, "$", PACKET).alias("p"), F.schema_of_variant(document).startswith("OBJECT").alias("ok"))
    parsed = packets.select("*", F.explode(F.array(read)).alias("_read")).select("*", "_read.*").drop("_read")
    feed = _lookup(F.lower(F.trim("p.type")), FEED_TYPES)
    codes = {str(code): name for code, name in SEGMENT_CODES.items()}
    segment = _lookup(F.col("p.exchange_segment").cast("string"), codes)
    ok = F.coalesce(F.col("ok"), F.lit(False))
    known = parsed.withColumns({"_feed": feed, "_segment": segment}).filter(~ok | F.col("_feed").isNotNull())
    reason = (
        F.when(~ok, "unparsable")
        .when(F.col("_segment").isNull(), "invalid exchange_segment")
        .when(F.coalesce(F.col("p.security_id"), F.lit(0)) <= 0, "invalid security_id")
    )

    # A close of nothing, "", 0 or false falls back to the previous close.
    close = F.to_json("p.close")
    empty = (
        close.isNull() | close.isin("null", '""', "false", "[]", "{}")
        | F.coalesce(close.try_cast("double") == 0, F.lit(False))
    )
    received = F.col("received_at")
    rows = known.withColumns({
        "reason": reason, "_time": m.exchange_time(F.col("p.LTT"), received, local=False)})
    values = record(
        source=F.lit(source), batch_id=F.col("batch_id"), sequence=F.col("sequence"),
        event_id=m.event_id(F.col("batch_id"), F.col("_segment"), F.col("p.security_id"), F.col("sequence")),
        feed_type=F.col("_feed"), exchange_segment=F.col("_segment"),
        security_id=F.col("p.security_id"), received_at=received, exchange_time=F.col("_time"),
        trading_date=m.trading_date(F.col("_time"), received),
        last_price=F.col("p.LTP"), last_quantity=F.col("p.LTQ"), average_price=F.col("p.avg_price"),
        volume=F.col("p.volume"), buy_quantity=F.col("p.total_buy_quantity"),
        sell_quantity=F.col("p.total_sell_quantity"),
        open=F.col("p.open"), high=F.col("p.high"), low=F.col("p.low"),
        close=F.when(empty, F.col("p.prev_close")).otherwise(m.fields("p.close", "$", "double")),
        open_interest=F.col("p.OI"), previous_open_interest=F.col("p.prev_OI"),
        oi_day_high=F.col("p.oi_day_high"), oi_day_low=F.col("p.oi_day_low"),
        depth_json=m.stable_json(F.col("p.depth")),
    )
    return rows.select("reason", "payload", *values)


def rejects(tagged: DataFrame) -> DataFrame:
    """The packets of ``tag_packets`` that have a reason, for a table of their own."""
    return tagged.filter(F.col("reason").isNotNull()).select(
        "payload", "batch_id", "sequence", "received_at", "reason")


def normalize_packets(packets: DataFrame, strict: bool = False,
                      source: str = "broker") -> tuple[DataFrame, DataFrame]:
    """``(payload, batch_id, sequence, received_at)`` rows to ``(records, rejected)``.

    See ``tag_packets``; with ``strict`` a packet with a reason fails the job. Works on batch
    and streaming frames. Each of the two frames parses the payloads: a job that writes
    both should write the tagged rows once, as ``land_packets`` does.
    """
    tagged = tag_packets(packets, source)
    good = F.col("reason").isNull()
    if strict:
        good = F.when(good, True).otherwise(F.raise_error(
            F.concat(F.lit("A live packet is refused: "), F.col("reason"))).cast("boolean"))
    return tagged.filter(good).select(*RECORD), rejects(tagged)


def json_columns(df: DataFrame) -> list[Column]:
    """The columns in the form they have in a landed event: ISO times with Z, no NaN."""
    def field(f: T.StructField) -> Column:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            return m.iso_utc(value).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            finite = ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
            refuse = F.raise_error(F.lit(f"{f.name} is not a finite number"))
            return F.when(value.isNull() | finite, value).otherwise(refuse).alias(f.name)
        return value.alias(f.name)

    return [field(f) for f in df.schema]


def to_event_json(df: DataFrame) -> DataFrame:
    """Rows as one ``value`` column of compact JSON, nulls kept."""
    return df.select(F.to_json(F.struct(*json_columns(df)), {"ignoreNullFields": "false"}).alias("value"))
