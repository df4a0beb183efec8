"""Numbering and look-ahead against plain Python, with a key that holds most rows."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from tierlake.operators.sequences import day_gap, numbered


def skewed(n, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [
        (rng.choice(["hot"] * 8 + ["a", "b", None]),
         start + timedelta(hours=rng.randrange(0, 400), seconds=rng.randrange(3) * 20), i)
        for i in range(n)
    ]


def gaps(data):
    expected, groups = {}, defaultdict(list)
    for key, at, i in data:
        if at is None:
            expected[i] = None
        else:
            groups[key].append((at, i))
    for members in groups.values():
        members.sort()
        for (at, i), later in zip(members, [*members[1:], None]):
            expected[i] = None if later is None else (later[0] - at) // timedelta(days=1)
    return expected


def test_numbered(spark):
    data = skewed(2000, 1)
    groups = defaultdict(list)
    for key, at, i in data:
        groups[key].append((at, i))
    expected = {i: n for members in groups.values() for n, (_, i) in enumerate(sorted(members), 1)}
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, i int")
    got = numbered(df, ["k"], [F.date_trunc("hour", "at")], [F.col("at"), F.col("i")], "n")
    assert got.columns == ["k", "at", "i", "n"]
    assert {r["i"]: r["n"] for r in got.collect()} == expected


def test_day_gap_of_timestamps(spark):
    data = skewed(2000, 2) + [("hot", None, 2000), (None, None, 2001)]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, i int")
    got = {r["i"]: r["d_diff"] for r in day_gap(df, "k", "at", ["i"]).collect()}
    assert got == gaps(data)


def test_day_gap_of_dates_with_ties(spark):
    rng = random.Random(3)
    data = [("hot", date(2024, 1, 1) + timedelta(days=rng.choice([0, 0, 0, 5, 9])), i) for i in range(300)]
    data += [("one", date(2024, 1, 1), 300)]
    df = spark.createDataFrame(data, "k string, at date, i int")
    got = {r["i"]: r["d_diff"] for r in day_gap(df, "k", "at", ["i"]).collect()}
    assert got == gaps(data)


def test_a_day_is_24_hours(spark):
    data = [("k", datetime(2024, 1, 1, 23), 1), ("k", datetime(2024, 1, 2, 22), 2), ("k", datetime(2024, 1, 3, 22), 3)]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, i int")
    assert {r["i"]: r["d_diff"] for r in day_gap(df, "k", "at", ["i"]).collect()} == {1: 0, 2: 1, 3: None}
