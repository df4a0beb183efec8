"""Snapshot payloads, live packets, exchange clocks, landed events."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tierlake.functions import market as m
from tierlake.sources.market import (
    RECORD, flatten_snapshots, normalize_packets, read_payloads, to_event_json)

RECEIVED = datetime(2026, 10, 25, 4, 0, 5)


def payloads(spark, *documents):
    texts = [(d if isinstance(d, str) else json.dumps(d), f"b{i}", RECEIVED) for i, d in enumerate(documents)]
    return spark.createDataFrame(texts, "payload string, batch_id string, received_at timestamp_ntz").withColumn(
        "received_at", F.col("received_at").cast("timestamp"))


def quote(**fields):
    return {"status": "success", "data": {"NSE_EQ": {"1333": fields}}}


def test_snapshot(spark):
    document = quote(last_price=42.25, last_trade_time="25/10/2026 09:15:00",
                     ohlc={"open": 40, "high": 43, "low": 39, "close": 41},
                     depth={"sell": [], "buy": [{"b": 1, "a": 2.5}]}, volume=None, oi="")
    row = flatten_snapshots(payloads(spark, document), "quote").selectExpr(
        "*", "string(exchange_time) AS at", "string(trading_date) AS day").first()
    assert (row.feed_type, row.exchange_segment, row.security_id, row.sequence) == ("quote", "NSE_EQ", "1333", 1)
    assert (row.last_price, row.open, row.high, row.low, row.close) == (42.25, 40.0, 43.0, 39.0, 41.0)
    assert (row["at"], row["day"]) == ("2026-10-25 03:45:00", "2026-10-25")
    assert row.volume is None and row.open_interest is None
    assert row.depth_json == '{"buy":[{"a":2.5,"b":1}],"sell":[]}'
    assert flatten_snapshots(payloads(spark, document), "q").dtypes == list(RECORD.items())


def test_sequence_is_by_segment_and_numeric_id(spark):
    document = {"status": "SUCCESS", "data": {
        "NSE_EQ": {"100": {}, "20": {}, "3": 5, "4": "text"}, "IDX_I": {"13": {}}, "ODD": [1], "NONE": None}}
    got = flatten_snapshots(payloads(spark, document, quote()), "q")
    assert rows(got, "batch_id", "sequence", "exchange_segment", "security_id") == [
        ("b0", 1, "IDX_I", "13"), ("b0", 2, "NSE_EQ", "20"), ("b0", 3, "NSE_EQ", "100"), ("b1", 1, "NSE_EQ", "1333")]
    ids = [r.event_id for r in got.collect()]
    assert len(set(ids)) == 4 and sorted(ids) == sorted(r.event_id for r in got.collect())


@pytest.mark.parametrize("document, message", [
    ({"status": "failure", "data": {}}, "no success"), ({"data": {}}, "no success"), ("no json", "no success"),
    ({"status": "success"}, "no data"), ({"status": "success", "data": [1]}, "no data"),
    ({"status": "success", "data": {}}, "quotes no instrument"),
    ({"status": "success", "data": {"NSE_EQ": {"1": 2}}}, "quotes no instrument"),
])
def test_bad_snapshots_fail(spark, document, message):
    with pytest.raises(Exception, match=message):
        flatten_snapshots(payloads(spark, quote(), document), "q").collect()


def test_lenient_numbers(spark):
    def read(**fields):
        return flatten_snapshots(payloads(spark, quote(**fields)), "q").first()

    assert read(last_price="", volume="").last_price is None
    assert read(last_price="42.5").last_price == 42.5
    assert read(last_price="x").last_price is None
    assert read(volume=12.7).volume == 12 and read(volume="12.7").volume is None and read(volume="12").volume == 12
    assert read(ohlc="none").open is None


@pytest.mark.parametrize("text, local, expected", [
    ("25/10/2026 09:15:00", True, "2026-10-25 03:45:00"), ("25/10/2026 09:15:00", False, "2026-10-25 09:15:00"),
    ("2026-10-25 09:15:00", True, "2026-10-25 03:45:00"), ("5/1/2026 9:15:00", False, "2026-01-05 09:15:00"),
    ("09:15:30", True, "2026-10-25 09:15:30"), ("09:15", False, "2026-10-25 09:15:00"),
    ("09:15:30.250", True, "2026-10-25 09:15:30.25"), ("25/10/2026 02:00:00", True, "2026-10-24 20:30:00"),
    ("01/01/1980 00:00:00", True, None), ("", True, None), (None, True, None), ("soon", True, None),
    ("99:99", True, None), ("31/02/2026 00:00:00", True, None),
])
def test_exchange_time(spark, text, local, expected):
    df = spark.createDataFrame([(text,)], "t string").select(
        m.exchange_time(F.col("t"), F.lit("2026-10-25 04:00:05").cast("timestamp"), local).cast("string"))
    assert df.first()[0] == expected


def test_trading_date(spark):
    def day(at, received):
        df = spark.range(1).select(m.trading_date(
            F.lit(at).cast("timestamp"), F.lit(received).cast("timestamp")).cast("string"))
        return df.first()[0]

    assert day("2026-10-24 18:29:00", "2026-10-25 04:00:00") == "2026-10-24"
    assert day("2026-10-24 18:30:00", "2026-10-25 04:00:00") == "2026-10-25"
    assert day(None, "2026-10-25 19:00:00") == "2026-10-26"


def packets(spark, *documents):
    return payloads(spark, *documents).withColumn("sequence", F.substring("batch_id", 2, 9).cast("bigint"))


def test_packets(spark):
    ok = {"exchange_segment": 1, "security_id": 1333, "LTP": "42.5", "LTT": "09:15:00"}
    records, rejected = normalize_packets(packets(
        spark, {"type": "Ticker Data", **ok}, {"type": "Quote Data", **ok, "volume": 7}, {"type": " full data ", **ok},
        {"type": "OI Data", **ok, "OI": 5, "prev_OI": "4"}, {"type": "Previous Close", **ok, "prev_close": "41.5"},
        {"type": "Market Status", **ok}, "[1]", "null", {"type": "Ticker Data", "exchange_segment": 99, "security_id": 1},
        {"type": "Ticker Data", "exchange_segment": 0}, {"type": "Ticker Data", "exchange_segment": 0, "security_id": -1}))
    assert rows(records, "sequence", "feed_type", "open_interest", "previous_open_interest", "close") == [
        (0, "ticker", None, None, None), (1, "quote", None, None, None), (2, "full", None, None, None),
        (3, "open_interest", 5, 4, None), (4, "previous_close", None, None, 41.5)]
    first = records.filter("sequence = 0").selectExpr("*", "string(exchange_time) AS at").first()
    assert (first.exchange_segment, first.security_id, first.last_price) == ("NSE_EQ", "1333", 42.5)
    assert first["at"] == "2026-10-25 09:15:00"
    assert rows(rejected, "sequence", "reason") == [
        (10, "invalid security_id"), (6, "unparsable"), (7, "unparsable"), (8, "invalid exchange_segment"),
        (9, "invalid security_id")]
    broken, refused = normalize_packets(packets(spark, '{"type": "Ticker Data"', "", None, {"type": "Ticker Data", **ok}))
    assert broken.count() == 1 and rows(refused, "sequence", "reason") == [(i, "unparsable") for i in range(3)]
    with pytest.raises(Exception, match="unparsable"):
        normalize_packets(packets(spark, "{"), strict=True)[0].collect()
    with pytest.raises(Exception, match="invalid exchange_segment"):
        normalize_packets(packets(spark, {"type": "Ticker Data", "exchange_segment": 99}), strict=True)[0].collect()


@pytest.mark.parametrize("close, expected", [
    (5, 5.0), ("5", 5.0), (0, 3.0), (0.0, 3.0), ("", 3.0), (None, 3.0), ("0", 0.0), (False, 3.0), ("x", None)])
def test_close_falls_back(spark, close, expected):
    packet = {"type": "Full Data", "exchange_segment": 1, "security_id": 1, "close": close, "prev_close": 3}
    assert normalize_packets(packets(spark, packet))[0].first().close == expected


def test_event_json(spark):
    df = spark.sql("SELECT timestamp'2026-10-25 04:00:05' AS a, timestamp'2026-10-25 04:00:05.25' AS b, "
                   "date'2026-10-25' AS d, 1.5D AS x, CAST(NULL AS STRING) AS n")
    assert to_event_json(df).first()[0] == (
        '{"a":"2026-10-25T04:00:05Z","b":"2026-10-25T04:00:05.250000Z","d":"2026-10-25","x":1.5,"n":null}')
    with pytest.raises(Exception, match="not a finite number"):
        to_event_json(spark.sql("SELECT double('NaN') AS x")).collect()


def test_payload_files(spark, tmp_path):
    for name, price in (("a", 1), ("b", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps(quote(last_price=price), indent=2))
    found = flatten_snapshots(read_payloads(spark, str(tmp_path)), "q")
    assert rows(found, "last_price") == [(1.0,), (2.0,)]
    assert found.select("batch_id").distinct().count() == 2
    assert abs(found.first().received_at - datetime.now()) < timedelta(days=1)


def test_run_date_in_a_zone(spark):
    at = F.lit("2026-10-24 20:00:00").cast("timestamp")
    assert str(spark.range(1).select(m.run_date(at, "Asia/Kolkata")).first()[0]) == "2026-10-25"
