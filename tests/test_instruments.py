"""Request lists, watchlists, the master and the lookup."""

import pytest

from tests.conftest import rows
from tierlake.operators.instruments import classify_instruments, resolve_instruments
from tierlake.sources.instruments import (
    MASTER_COLUMNS, parse_instruments, parse_symbols, read_master, read_watchlist)

HEADER = ",".join([*MASTER_COLUMNS, "SEM_CUSTOM_SYMBOL"])
MASTER = [
    "NSE,E,2885,EQUITY,RELIANCE,EQ,,Reliance Industries", "NSE,E,1333,EQUITY,HDFCBANK,EQ,,HDFC Bank",
    "NSE,E,00100,EQUITY,ARE&M,EQ,,Amara Raja", "NSE,I,13,INDEX,NIFTY,X,,Nifty 50",
    "NSE,D,500,FUTIDX,NIFTY-Nov2026-FUT,XX,2026-11-26 14:30:00,NIFTY NOV FUT",
    "NSE,D,501,FUTIDX,NIFTY-Oct2026-FUT,XX,2026-10-01 14:30:00,NIFTY OCT FUT",
    "NSE,C,600,OPTCUR,USDINR-Nov2026-CE,XX,2026-11-26,USDINR", "NSE,C,601,OPTCUR,USDINR-ODD,XX,soon,USDINR",
    "BSE,E,9,EQUITY,RELIANCE,EQ,,Reliance", "NSE,E,10,EQUITY,BOND,GB,,Bond",
    "NSE,E,7,EQUITY,TWICE,EQ,,Twice", "NSE,E,8,EQUITY,TWICE,EQ,,Twice", "NSE,E,0,EQUITY,ZERO,EQ,,Zero",
]


@pytest.fixture
def master(spark, tmp_path):
    path = tmp_path / "master.csv"
    path.write_text("\n".join([HEADER, *MASTER]) + "\n")
    return read_master(spark, str(path))


def test_symbols(spark):
    found = parse_symbols(spark, " reliance ,NSE_EQ:RELIANCE,are&m,IDX_I:Nifty 50,NSE_FNO:NIFTY-Nov2026-FUT")
    assert [tuple(r)[1:] for r in found.collect()] == [
        ("NSE_EQ", "RELIANCE"), ("NSE_EQ", "ARE&M"), ("IDX_I", "NIFTY 50"), ("NSE_FNO", "NIFTY-NOV2026-FUT")]
    for text in ("", " ", "A,,B", "BSE:A", "A:B:C", "NSE_EQ:", "A;B", "A" * 129):
        with pytest.raises(ValueError):
            parse_symbols(spark, text)
    with pytest.raises(ValueError):
        parse_symbols(spark, "A,B", max_instruments=1)
    assert parse_symbols(spark, "A,a", max_instruments=1).count() == 1


def test_explicit_ids(spark):
    found = parse_instruments(spark, "nse_eq: 01333 ,IDX_I:13,NSE_EQ:1333")
    assert [tuple(r)[1:] for r in found.collect()] == [("NSE_EQ", "1333"), ("IDX_I", "13")]
    for text in ("1333", "NSE_EQ:0", "NSE_EQ:-1", "NSE_EQ:RELIANCE", "BSE:1", "NSE_EQ:1:2", "NSE_EQ:1,"):
        with pytest.raises(ValueError):
            parse_instruments(spark, text)


def test_watchlist(spark, tmp_path):
    path = tmp_path / "symbols.csv"

    def read(text, **kw):
        path.write_bytes(text.encode() if isinstance(text, str) else text)
        return [(r[1], r[2]) for r in read_watchlist(spark, str(path), **kw).collect()]

    assert read("﻿Symbol\r\n\r\nreliance\r\n\"Idx_I:Nifty 50\"\r\nRELIANCE\r\n") == [
        ("NSE_EQ", "RELIANCE"), ("IDX_I", "NIFTY 50")]
    for text in ("", "symbol\n", "name\nA\n", "symbol,x\nA,1\n", "symbol\nA,B\n", "symbol\n\"A,B\"\n", "symbol\n \n",
                 "symbol\nA;B\n", "symbol\n" + "A\n" * 600_000):
        with pytest.raises(ValueError):
            read(text)
    with pytest.raises(ValueError):
        read("symbol\nA\nB\n", max_instruments=1)


def test_active_instruments(master):
    found = classify_instruments(master, "2026-10-25")
    assert rows(found, "SEM_SMST_SECURITY_ID", "exchange_segment") == [
        ("0", "NSE_EQ"), ("00100", "NSE_EQ"), ("13", "IDX_I"), ("1333", "NSE_EQ"), ("2885", "NSE_EQ"),
        ("500", "NSE_FNO"), ("600", "NSE_CURRENCY"), ("7", "NSE_EQ"), ("8", "NSE_EQ")]
    assert classify_instruments(master, "2026-11-26").filter("exchange_segment = 'NSE_FNO'").count() == 1
    assert classify_instruments(master, "2026-11-27").filter("exchange_segment = 'NSE_FNO'").count() == 0


def test_lookup(spark, master):
    def resolve(text):
        parts = resolve_instruments(parse_symbols(spark, text), master, "2026-10-25")
        return [[(r["symbol"], r["security_id"]) for r in part.orderBy("position").collect()] for part in parts]

    assert resolve("are&m,reliance,IDX_I:Nifty 50,NSE_FNO:NIFTY-Nov2026-FUT,NSE_CURRENCY:USDINR-Nov2026-CE") == [
        [("ARE&M", "100"), ("RELIANCE", "2885"), ("NIFTY 50", "13"), ("NIFTY-NOV2026-FUT", "500"),
         ("USDINR-NOV2026-CE", "600")], [], []]
    assert resolve("RELI,NIFTY,HDFC BANK,BOND,ZERO,NSE_FNO:NIFTY,NSE_FNO:NIFTY-Oct2026-FUT,NSE_CURRENCY:USDINR-ODD")[1] == [
        (s, None) for s in ("RELI", "NIFTY", "HDFC BANK", "BOND", "ZERO", "NIFTY", "NIFTY-OCT2026-FUT", "USDINR-ODD")]
    assert resolve("TWICE,IDX_I:NIFTY,IDX_I:NIFTY 50")[2] == [("TWICE", None), ("NIFTY", None), ("NIFTY 50", None)]


def test_broken_masters(spark, tmp_path):
    def read(text):
        path = tmp_path / "broken.csv"
        path.write_text(text)
        return read_master(spark, str(path)).collect()

    for text in ("", HEADER + "\n", HEADER.replace("SEM_SERIES,", "") + "\nx\n", HEADER + ",SEM_SERIES\n" + "x\n"):
        with pytest.raises(ValueError):
            read(text)
    for line in ("NSE,E,1", MASTER[0] + ",more"):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|FAILFAST"):
            read("\n".join([HEADER, MASTER[0], line]) + "\n")
