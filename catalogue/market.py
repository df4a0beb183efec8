"""Market payloads, live packets, stable JSON and the instrument lookup.

The payloads are JSON texts that Spark builds from the rows of the given tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import layers, load, query, stamp
from tierlake import tables
from tierlake.functions.market import normalise_json
from tierlake.operators.instruments import classify_instruments, match_instruments
from tierlake.plans.bronze import bronze_full
from tierlake.plans.lake import ingest
from tierlake.plans.silver import live_ticks_model, market_snapshot_model
from tierlake.session import workspace
from tierlake.sources.instruments import read_master
from tierlake.sources.market import (
    RECORD, SNAPSHOT_KEY, TICK_KEY, flatten_snapshots, market_contract, normalize_packets, to_event_json)


SECOND = "date_trunc('second', ts)"


def record_sql(**given):
    """DuckDB text of the 28 columns; what is not given is null."""
    kinds = {"bigint": "BIGINT", "double": "DOUBLE"}
    return ", ".join(f"{given[name]} AS {name}" if name in given else f"CAST(NULL AS {kinds.get(kind, 'VARCHAR')}) AS {name}"
                     for name, kind in RECORD.items())


def dealt(payloads):
    """The rows over all cores, in tasks small enough to even out: they come from one file here, and reading the
    payloads made of them costs many times the shuffle."""
    return payloads.repartition(4 * payloads.sparkSession.sparkContext.defaultParallelism)


QUOTES = f"""
quotes AS (
  SELECT event_id, ts, 'NSE_EQ' AS segment, CAST(event_id + 1000 AS VARCHAR) AS id, value, event_id + 2000000 AS q FROM events
  UNION ALL SELECT event_id, ts, 'NSE_EQ', CAST(event_id + 2000000 AS VARCHAR), value, event_id + 2000000 FROM events
  UNION ALL SELECT event_id, ts, 'IDX_I', '7', NULL, NULL FROM events),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY segment, length(id), id) AS BIGINT) AS sequence FROM quotes),
records AS (SELECT {record_sql(
    source="'broker'", batch_id="CAST(event_id AS VARCHAR)", sequence="sequence",
    event_id="sha256(event_id || ':' || segment || ':' || id || ':' || sequence)", feed_type="'quote'",
    exchange_segment="segment", security_id="id", received_at=stamp("ts"),
    trading_date="strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d')",
    exchange_time=f"CASE WHEN id <> '7' THEN {stamp(SECOND)} END",
    last_price="value", last_quantity="CAST(trunc(value) AS BIGINT)", volume="CASE WHEN id = '7' THEN 12 ELSE q END",
    open="value", depth_json="CASE WHEN id <> '7' THEN '{\"buy\":[{\"p\":1,\"q\":' || q || '}],\"sell\":[]}' END")}
  FROM numbered)"""


def snapshot_payloads(spark, sf):
    """One response per event, with three instruments in two segments."""
    quote = ('{"last_price": %2$s, "volume": "%3$d", "last_quantity": %2$s, "average_price": "", '
             '"last_trade_time": "%4$s", "ohlc": {"open": "%2$s", "close": "n/a"}, '
             '"depth": {"sell": [], "buy": [{"q": %3$d, "p": 1}]}}')
    text = ('{"status": "Success", "data": {"NSE_EQ": {"%1$d": ' + quote + ', "%3$d": ' + quote
            + ', "skipped": 5}, "IDX_I": {"7": {"last_price": null, "oi": "12.7", "volume": 12.7}}, "EMPTY": {}}}')
    traded = F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL '5:30' HOUR TO MINUTE"), "dd/MM/yyyy HH:mm:ss")
    return load(spark, sf, "events").select(
        F.format_string(text, F.col("event_id") + 1000, F.col("value").cast("string"),
                        F.col("event_id") + 2000000, traded).alias("payload"),
        F.col("event_id").cast("string").alias("batch_id"),
        F.col("ts").cast("timestamp").alias("received_at"))


@query(f"WITH {QUOTES} SELECT * FROM records")
def payload_flatten(spark, sf):
    return flatten_snapshots(dealt(snapshot_payloads(spark, sf)), "quote")


@query(f"""
WITH {QUOTES}
SELECT *, '2024-01-31' AS snapshot_date FROM records
QUALIFY row_number() OVER (PARTITION BY exchange_segment, security_id ORDER BY received_at DESC, CAST(batch_id AS BIGINT) DESC) = 1
""")
def model_market_snapshot(spark, sf):
    # One index is in every payload: a third of all quotes have the same key.
    space, sheet = layers(spark), market_contract(SNAPSHOT_KEY)
    quotes = flatten_snapshots(dealt(snapshot_payloads(spark, sf)), "quote")
    ingest(spark, space, "quotes", quotes, sheet, "2024-01-31")
    bronze_full(spark, space, "quotes", "2024-01-31", sheet)
    for _ in range(2):
        market_snapshot_model(spark, space, "quotes", "2024-01-31")
    return tables.read(spark, space.resolve("nse_market_snapshot", "silver"))


def packets(spark, sf):
    """One packet per event; errors are control packets, every fifth user has a bad segment."""
    kind = F.create_map(*(F.lit(v) for pair in {
        "click": "Ticker Data", "view": " quote data", "purchase": "Full Data",
        "signup": "Previous Close", "error": "Disconnect"}.items() for v in pair))
    body = ('{"type": "%s", "exchange_segment": %d, "security_id": "%d", "LTP": "%s", "LTQ": %d, '
            '"LTT": "%s", "close": %d, "prev_close": %s, "OI": "x"}')
    return load(spark, sf, "events").select(
        F.format_string(body, kind[F.col("event_type")], F.col("user_id") % 5, F.col("user_id"),
                        F.col("value").cast("string"), F.col("event_id"),
                        F.date_format("ts", "HH:mm:ss"), F.col("event_id") % 2,
                        F.col("value").cast("string")).alias("payload"),
        F.lit("b").alias("batch_id"), F.col("event_id").alias("sequence"),
        F.col("ts").cast("timestamp").alias("received_at"))


SEGMENT = "CASE user_id % 5 WHEN 0 THEN 'IDX_I' WHEN 1 THEN 'NSE_EQ' WHEN 2 THEN 'NSE_FNO' ELSE 'NSE_CURRENCY' END"


def ticks_sql(received="ts"):
    """DuckDB text of the records of all good packets; the time of receipt may be another than the event's."""
    exchange = f"(CAST({received} AS DATE) + CAST({SECOND} AS TIME))"
    columns = record_sql(
        source="'broker'", batch_id="'b'", sequence="event_id",
        event_id=f"sha256('b:' || {SEGMENT} || ':' || user_id || ':' || event_id)",
        feed_type="CASE event_type WHEN 'click' THEN 'ticker' WHEN 'view' THEN 'quote' WHEN 'purchase' THEN 'full' ELSE 'previous_close' END",
        exchange_segment=SEGMENT, security_id="CAST(user_id AS VARCHAR)", received_at=stamp(received),
        trading_date=f"strftime({exchange} + INTERVAL 330 MINUTE, '%Y-%m-%d')", exchange_time=stamp(exchange),
        last_price="value", last_quantity="event_id", close="CASE WHEN event_id % 2 = 0 THEN value ELSE 1 END")
    return f"SELECT {columns} FROM events WHERE event_type <> 'error' AND user_id % 5 <> 4 AND user_id > 0"


TICKS = ticks_sql()


@query(TICKS)
def live_packets(spark, sf):
    rows, _ = normalize_packets(dealt(packets(spark, sf)))
    return rows


@query("""
SELECT event_id AS sequence, CASE WHEN user_id % 5 = 4 THEN 'invalid exchange_segment'
       ELSE 'invalid security_id' END AS reason
FROM events WHERE event_id % 7 <> 0 AND event_type <> 'error' AND (user_id % 5 = 4 OR user_id <= 0)
UNION ALL SELECT event_id, 'unparsable' FROM events WHERE event_id % 7 = 0
""")
def live_rejected(spark, sf):
    # Every seventh packet is cut off.
    cut = F.when(F.col("sequence") % 7 == 0, F.substring("payload", 1, 20)).otherwise(F.col("payload"))
    _, rejected = normalize_packets(packets(spark, sf).withColumn("payload", cut))
    return rejected.select("sequence", "reason")


@query(f"SELECT *, '2024-01-31' AS snapshot_date FROM ({TICKS})")
def model_live_ticks(spark, sf):
    # The ticks arrive twice; the model has each of them once.
    space, sheet = layers(spark), market_contract(TICK_KEY)
    ticks, _ = normalize_packets(packets(spark, sf))
    for _ in range(2):
        ingest(spark, space, "ticks", ticks, sheet, "2024-01-31", "append")
    bronze_full(spark, space, "ticks", "2024-01-31", sheet)
    live_ticks_model(spark, space, "ticks", "2024-01-31")
    return tables.read(spark, space.resolve("nse_live_ticks", "silver"))


@query("""
SELECT event_id, '{"a":{"m":[' || user_id || ',null],"z":' || substr(props, 7) || ',"z":"' || event_type || '"}' AS doc
FROM events
""")
def json_stable(spark, sf):
    # props is {"k": n}; its number goes into an unsorted document with blanks.
    number = F.substring("props", 7, 100)
    number = F.regexp_replace(number, "}", "")
    text = F.concat(F.lit('{ "z" : "'), F.col("event_type"), F.lit('", "a" : {"z": '), number,
                    F.lit(', "m": ['), F.col("user_id"), F.lit(', null] } }'))
    return load(spark, sf, "events").select("event_id", normalise_json(text).alias("doc"))


@query("""
SELECT '{"event_id":' || event_id || ',"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN date_trunc('second', ts) = ts THEN '' ELSE strftime(ts, '.%f') END
       || 'Z","day":"' || strftime(ts, '%Y-%m-%d') || '","kind":"' || event_type || '","none":null}' AS value
FROM events
""")
def event_json(spark, sf):
    return to_event_json(load(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("at"), F.to_date("ts").alias("day"),
        F.col("event_type").alias("kind"), F.lit(None).cast("string").alias("none")))


def master(spark, sf):
    """The parts read as an instrument master; the type decides the segment."""
    kind, size = F.col("p_type"), F.col("p_size")

    def by_type(economy, promo, other):
        return F.when(kind == "ECONOMY", economy).when(kind == "PROMO", promo).otherwise(other)

    return load(spark, sf, "part").select(
        F.lit("NSE").alias("SEM_EXM_EXCH_ID"), by_type("E", "I", "D").alias("SEM_SEGMENT"),
        F.format_string("%07d", F.col("p_partkey") + 1).alias("SEM_SMST_SECURITY_ID"),
        by_type("EQUITY", "INDEX", "FUTSTK").alias("SEM_INSTRUMENT_NAME"),
        F.concat_ws("-", "p_name", "p_brand").alias("SEM_TRADING_SYMBOL"),
        F.when(kind == "ECONOMY", "EQ").alias("SEM_SERIES"),
        F.concat(F.lit("2026-"), F.format_string("%02d", size % 12 + 1), F.lit("-15 14:30:00")).alias("SEM_EXPIRY_DATE"),
        F.concat(F.lit("Shown "), F.col("p_partkey")).alias("SEM_CUSTOM_SYMBOL"))


@query("""
SELECT printf('%07d', p_partkey + 1) AS "SEM_SMST_SECURITY_ID", p_name || '-' || p_brand AS "SEM_TRADING_SYMBOL",
       CASE p_type WHEN 'ECONOMY' THEN 'NSE_EQ' WHEN 'PROMO' THEN 'IDX_I' ELSE 'NSE_FNO' END AS exchange_segment
FROM part WHERE p_type IN ('ECONOMY', 'PROMO') OR p_size % 12 + 1 >= 6
""")
def instrument_master_scan(spark, sf):
    path = workspace(spark, "master")
    master(spark, sf).write.option("header", True).csv(path)
    active = classify_instruments(read_master(spark, path), "2026-06-01")
    return active.select("SEM_SMST_SECURITY_ID", "SEM_TRADING_SYMBOL", "exchange_segment")


@query("""
WITH active AS (
  SELECT CASE p_type WHEN 'ECONOMY' THEN 'NSE_EQ' WHEN 'PROMO' THEN 'IDX_I' ELSE 'NSE_FNO' END AS seg,
         CAST(p_partkey + 1 AS VARCHAR) AS id, upper(p_name || '-' || p_brand) AS sym, 'SHOWN ' || p_partkey AS shown
  FROM part WHERE p_type IN ('ECONOMY', 'PROMO') OR p_size % 12 + 1 >= 6),
names AS (SELECT seg, id, sym FROM active UNION SELECT seg, id, shown FROM active WHERE seg = 'IDX_I'),
requests AS (
  SELECT DISTINCT s.seg, upper(p_name || '-' || p_brand) AS sym FROM part, (VALUES ('NSE_EQ'), ('IDX_I'), ('NSE_FNO')) s(seg)
  UNION SELECT 'IDX_I', 'SHOWN ' || p_partkey FROM part),
counted AS (SELECT r.seg, r.sym, count(DISTINCT id) AS n, min(id) AS id FROM requests r LEFT JOIN names USING (seg, sym)
  GROUP BY r.seg, r.sym),
shared AS (SELECT seg, id FROM counted WHERE n = 1 GROUP BY seg, id HAVING count(*) > 1)
SELECT c.seg AS exchange_segment, c.sym AS symbol,
       CASE WHEN n = 1 AND s.id IS NULL THEN c.id END AS security_id,
       CASE WHEN n = 0 THEN 'unknown' WHEN n > 1 OR s.id IS NOT NULL THEN 'ambiguous' ELSE 'resolved' END AS status
FROM counted c LEFT JOIN shared s ON s.seg = c.seg AND s.id = c.id AND c.n = 1
""")
def instrument_lookup(spark, sf):
    part = load(spark, sf, "part")
    symbol = F.upper(F.concat_ws("-", "p_name", "p_brand")).alias("symbol")
    segments = F.explode(F.array(F.lit("NSE_EQ"), F.lit("IDX_I"), F.lit("NSE_FNO"))).alias("exchange_segment")
    shown = part.select(F.lit("IDX_I").alias("exchange_segment"),
                        F.concat(F.lit("SHOWN "), F.col("p_partkey")).alias("symbol"))
    requests = part.select(segments, symbol).unionByName(shown).distinct()
    return match_instruments(requests, master(spark, sf), "2026-06-01")
