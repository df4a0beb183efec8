"""Product codes against plain Lloyd rounds over all vectors."""

import math

import numpy as np
import pytest

from tierlake.llm import vector_codes
from tierlake.llm.vector_codes import Coding, books_sha256, encode, kept, label_errors, train


def by_hand(rows, coding):
    """(rows that stay, codebooks, codes, errors) with Python integers."""
    good = [(i, x, label) for i, x, label in rows if x and all(v is not None and math.isfinite(v) for v in x)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(good[0][1])
    good = [(i, [math.floor(coding.scale * np.float64(np.float32(v))) for v in x], label) for i, x, label in good if len(x) == size]
    width = size // coding.parts
    first = {}
    for i, x, _ in good:
        first.setdefault(i, x)
    books = [[x[p * width : (p + 1) * width] for x in list(first.values())[: coding.entries]] for p in range(coding.parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    def assigned():
        return [[nearest(x[p * width : (p + 1) * width], books[p]) for p in range(coding.parts)] for _, x, _ in good]

    for _ in range(coding.rounds):
        met = assigned()
        for p in range(coding.parts):
            for e in range(len(books[p])):
                own = [good[r][1][p * width : (p + 1) * width] for r in range(len(good)) if met[r][p][1] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    return good, books, assigned()


def random_rows(n, seed, copies=0):
    pick = np.random.default_rng(seed)
    centre = pick.normal(size=(5, 12))
    x = (centre[pick.integers(0, 5, n)] + pick.normal(scale=0.3, size=(n, 12))).astype(np.float32)
    x[:copies] = x[0]
    return [(int(i) + 5, v.tolist(), int(i) % 3 if i % 7 else None) for i, v in enumerate(x)]


SCHEMA = "vec_id long, embedding array<float>, label int, entry int, position string, salt int, id int, x int"


@pytest.mark.parametrize("rounds,copies,members", [(6, 0, 50), (6, 200, 7), (0, 0, 50), (1, 3, 1000), (40, 0, 50)])
def test_against_plain_rounds(spark, rounds, copies, members):
    coding = Coding(parts=4, entries=9, rounds=rounds, members=members)
    rows = random_rows(400, rounds + copies, copies)
    inf, nan = float("inf"), float("nan")
    rows += [(1, None, 1), (2, [None] * 12, 1), (3, [inf] * 12, 1), (4, [nan] * 12, None), (900, [], 1), (901, [1.0] * 8, 1)]
    rows += [rows[0], rows[0], (None, rows[5][1], 2), (rows[1][0], rows[9][1], 0)]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], SCHEMA).repartition(5)
    good, books, met = by_hand(rows, coding)
    found = kept(docs, "vec_id", "embedding", "label")
    got_books = train(found, coding)
    assert got_books.tolist() == books
    totals = {}
    for (_, _, label), row in zip(good, met):
        totals[label] = totals.get(label, 0) + sum(d for d, _ in row)
    want = sorted(((i, label, [e for _, e in row], sum(d for d, _ in row), totals[label]) for (i, _, label), row in zip(good, met)), key=str)
    assert sorted(map(tuple, label_errors(encode(found, got_books, coding)).collect()), key=str) == want


def test_no_vectors_and_few(spark):
    coding = Coding(parts=2, entries=16)
    none = kept(spark.createDataFrame([(1, None, 1, 1, "x", 2, 3, 4)], SCHEMA), "vec_id", "embedding", "label")
    books = train(none, coding)
    assert label_errors(encode(none, books, coding)).count() == 0 and len(books_sha256(books)) == 64
    few = kept(spark.createDataFrame([(1, [0.5, -0.5], 1, 1, "x", 2, 3, 4)], SCHEMA), "vec_id", "embedding", "label")
    assert train(few, coding).tolist() == [[[2048]], [[-2048]]]
    with pytest.raises(ValueError):
        train(few, Coding(parts=4))


def test_whole_numbers_beyond_doubles():
    parts = np.array([[(1 << 27) + 1, 3]])
    book = np.array([[1 << 27, 0], [(1 << 27) + 1, 3]])
    assert [x.tolist() for x in vector_codes.nearest(parts, book)] == [[1], [0]]
