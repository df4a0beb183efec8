"""Periodic runs against a search over every period."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm.periodic_runs import Runs, catch, candidates, find
from tierlake.llm.queries import repeated_tail

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(words, rules=Runs()):
    found = {}
    for q in range(1, len(words) // rules.powers + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(rules.least, rules.powers * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("rules", [Runs(), Runs(powers=3, least=1), Runs(powers=5, least=9)])
def test_random_words(rules):
    pick = random.Random(7)
    for _ in range(700):
        words, most = [], pick.randrange(70)
        while len(words) < most:
            some = [pick.randrange(pick.choice([1, 2, 3, 9])) for _ in range(pick.randint(1, 7))]
            words += some * pick.choice([1, 1, 2, 4, 7])
        number = np.array(words, np.int64)
        want = by_hand(words, rules)
        assert catch(number, rules) == want
        spans = candidates(number, np.array([0, len(words)]), rules)
        assert sorted((a + s, n, q) for a, z, e in spans for s, n, q in catch(number[a:e], rules) if a + s <= z) == want


def test_odd_documents(odd, documents):
    rows, docs = odd
    more = [
        (20, "a " * 5), (21, "a " * 6), (22, "a b " * 4 + "a"), (23, "x " + "é b c\n" * 9 + "é b d"), (24, "a " * 9 + "b " + "a " * 9),
        (25, " ".join(f"w{i}" for i in range(900)) + " " + "p q r s t " * 400), (26, "k " * 30_000),
    ]
    docs = docs.unionByName(documents(more))
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find(docs).collect()), key=str)
    want = []
    for i, text in rows + more:
        words = WORD.findall(text or "")
        runs = by_hand(words) if i != 26 else [(0, 30_000, 1)]
        want.append((i, len(words), runs, collapsed(words, runs)))
    assert got == sorted(want, key=str)
    assert find(documents([])).count() == 0


def test_tails_repeat(spark):
    import zlib

    texts = {i: " ".join(f"w{k}" for k in range(i % 37)) for i in range(300)}
    docs = spark.createDataFrame([*texts.items(), (None, "a b"), (10_000, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in docs.select("doc_id", repeated_tail("text", "doc_id").alias("text")).collect()}
    changed = 0
    for i, text in texts.items():
        words, (g, digit) = text.split(), divmod(zlib.crc32(str(i).encode()), 10)
        n = len(words)
        if digit == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            changed += 1
        assert WORD.findall(got[i]) == words
    assert changed > 10 and got[None] == "a b" and not got[10_000]


def test_query_shape(spark):
    from tierlake.llm.queries import op13_periodic_runs

    out = op13_periodic_runs(spark, "/root/testdata/sf0.001")
    assert out.where("n_runs = 0").select(F.count("start"), F.count("period"), F.count("exponent_milli")).first() == (0, 0, 0)
    assert out.where("runs_sha256 IS NULL OR collapsed_sha256 IS NULL").count() == 0
