"""The classifier against plain loops over features in dictionaries, and scores that do not depend on neighbours."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tierlake.llm import quality_classifier
from tierlake.llm.quality_classifier import Training

LOW = {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def features(text):
    """Unigrams and bigrams of words and of shapes, and marks; square roots of counts, of unit length."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    low = ["".join(LOW.get(c, c) for c in word) for word in words]
    shapes = []
    for word in words:
        kinds = re.sub(rb"[0-9]", b"0", re.sub(rb"[A-Z]", b"A", re.sub(rb"[a-z\x80-\xff]", b"a", word.encode())))
        shapes.append(re.sub(rb"([aA0])\1+", rb"\1", kinds))
    found = [("word", w) for w in low] + [("shape", s) for s in shapes]
    for i in range(1, len(words)):
        found += [("words", low[i - 1], low[i]), ("shapes", shapes[i - 1], shapes[i]), ("same", low[i - 1] == low[i])]
    counts = {f: found.count(f) for f in found}
    length = math.sqrt(sum(counts.values()))
    return {f: math.sqrt(n) / length for f, n in counts.items()}


def fit(rows, t):
    z, n = {}, {}

    def weight(f):
        over = abs(z.get(f, 0.0)) - t.l1
        return -math.copysign(over, z[f]) / ((t.beta + math.sqrt(n[f])) / t.alpha + t.l2) if over > 0 else 0.0

    for _ in range(t.epochs):
        for text, label in rows:
            x = {**features(text), "bias": 1.0}
            w = {f: weight(f) for f in x}
            error = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items()))) - label
            for f, v in x.items():
                g, old = error * v, n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / t.alpha * w[f]
                n[f] = old + g * g
    return weight


GOOD, BAD = ["Calm", "text", "reads", "well", "Ünder", "10", "trees"], ["buy!!", "NOW", "$$$", "buy!!", "99999", "x#y", "win"]


def text_of(i):
    pool = GOOD if i % 2 else BAD
    return " ".join(pool[(i * 5 + k * k) % 7] for k in range(3 + i % 6))


@pytest.mark.parametrize("training", [Training(), Training(epochs=2, alpha=0.1, l1=0.1)])
def test_scores_are_those_of_plain_loops(spark, training):
    rows = [(i, text_of(i)) for i in range(80)] + [(80, None), (81, ""), (82, "never seen"), (83, "buy!! buy!! well")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, (i + (i % 9 == 0)) % 2) for i in range(60)], "doc_id long, quality int")
    made = quality_classifier.train(docs, labels, F.col("doc_id") % 4 != 2, "quality", training)
    placed = labels.filter("doc_id % 4 <> 2").orderBy(F.xxhash64("doc_id")).collect()
    weight = fit([(dict(rows)[r.doc_id], r.quality) for r in placed], training)
    out = quality_classifier.score(docs, made).collect()
    assert len(out) == len(rows)
    for r in out:
        x = {**features(dict(rows)[r.doc_id]), "bias": 1.0}
        wanted = 1 / (1 + math.exp(-sum(weight(f) * v for f, v in x.items())))
        assert r.score == pytest.approx(wanted, abs=1e-5)
        assert r.predicted == (r.score >= 0.7)


def test_a_score_does_not_depend_on_other_rows(spark):
    rows = [(i, text_of(i % 10)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    made = quality_classifier.train(docs, labels, F.lit(True), "quality")
    for parts in (1, 7, 40):
        by_text = {}
        for r in quality_classifier.score(docs.repartition(parts), made).collect():
            by_text.setdefault(r.doc_id % 10, set()).add(round(r.score, 12))
        assert all(len(scores) == 1 for scores in by_text.values())
