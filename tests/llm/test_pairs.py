"""Operators that compare texts: joins, repeats, leaks."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tierlake.llm import components, decontamination, jaccard_join, repeats, signature_tree, substring_dedup, suffix_array_dedup
from tierlake.llm.jaccard_join import Similarity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = WORD.findall(low)
    if len(found) >= k:
        return frozenset(tuple(found[i : i + k]) for i in range(len(found) - k + 1))
    return frozenset([tuple(found)]) if found else frozenset()


def joined_by_hand(rows, k, percent):
    """(doc_id, size, component, links) of each row."""
    sets = [shingles(t, k) for _, t in rows]
    up, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if None in (rows[i][0], rows[j][0]) or not both:
                continue
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return Counter(
        (doc, len(sets[i]), least[root(i)] if doc is not None else None, links[i]) for i, (doc, _) in enumerate(rows)
    )


@pytest.mark.parametrize("k, percent, limit", [(3, 90, 4_000_000), (5, 80, 300), (1, 30, 200)])
def test_join_equals_all_pairs(odd, k, percent, limit):
    rows, docs = odd
    found = jaccard_join.join(docs, Similarity(k, percent), limit).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found)
    assert got == joined_by_hand(rows, k, percent)


def test_join_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = jaccard_join.join(docs, Similarity(3, 90)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in found) == joined_by_hand(rows, 3, 90)


def test_one_of_each_group_stays(odd, documents):
    rows, docs = odd
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter(r.doc_id for r in kept.collect())
    components_by_hand = {d: c for d, _, c, _ in joined_by_hand(rows, 5, 80)}
    sized = {d: len(shingles(t, 5)) for d, t in rows}
    want = Counter(d for d, _ in rows if d is None)
    want.update({d for d in components_by_hand if d is not None and (components_by_hand[d] == d or not sized[d])})
    assert got == want
    assert jaccard_join.keep_one(documents([])).count() == 0


def test_tree_misses_no_pair():
    pick = np.random.default_rng(1)
    base = pick.integers(0, 2**63, 400, dtype=np.uint64)
    sets = []
    for i in range(300):
        size = int(pick.integers(5, 380))
        own = np.unique(np.concatenate([base[:size], pick.integers(0, 2**63, int(pick.integers(1, 40)), dtype=np.uint64)]))
        sets.append(np.sort(own))
    n = np.array([len(s) for s in sets])
    bits = signature_tree.bitmaps(np.repeat(np.arange(len(n)), n), np.concatenate(sets), n)
    shown = Counter()
    for i, j in signature_tree.similar(n, bits, 80):
        shown.update((min(x, y), max(x, y)) for x, y in zip(i.tolist(), j.tolist()))
    assert max(shown.values()) == 1
    for i in range(300):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (n[i] + n[j] - both):
                assert (j, i) in shown
    assert len(shown) < 300 * 299 / 4


@pytest.mark.parametrize("percent", [1, 10, 30])
def test_tree_misses_no_pair_of_widths_apart(percent):
    token = np.sort(np.random.default_rng(2).integers(0, 2**63, 700, dtype=np.uint64))
    sets = [token[:k] for k in (5, 20, 32, 40, 60, 100, 129, 260, 700)]
    n = np.array([len(s) for s in sets])
    bits = signature_tree.bitmaps(np.repeat(np.arange(len(n)), n), np.concatenate(sets), n)
    shown = Counter()
    for i, j in signature_tree.similar(n, bits, percent):
        shown.update((min(x, y), max(x, y)) for x, y in zip(i.tolist(), j.tolist()))
    linked = {(i, j) for j in range(len(n)) for i in range(j) if 100 * n[i] >= percent * n[j]}
    assert linked <= set(shown) and max(shown.values()) == 1
    assert (2, 5) in linked


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    found = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def cut_by_hand(units, length):
    """Which units of each text go."""
    count = Counter(tuple(u[i : i + length]) for u in units for i in range(len(u) - length + 1))
    out = []
    for u in units:
        gone = [False] * len(u)
        for i in range(len(u) - length + 1):
            if count[tuple(u[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append(gone)
    return out


@pytest.mark.parametrize("length, gram, hot", [(35, 12, 20_000), (35, 12, 1), (4, 2, 2)])
def test_word_repeats(odd, length, gram, hot):
    rows, docs = odd
    units = [WORD.findall(t or "") for _, t in rows]
    want = Counter()
    for (i, _), u, gone in zip(rows, units, cut_by_hand(units, length)):
        kept = " ".join(w for w, g in zip(u, gone) if not g)
        want[i, len(u), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert Counter(map(tuple, substring_dedup.dedup(docs, length, gram, hot).collect())) == want


@pytest.mark.parametrize("length, gram, hot", [(400, 200, 20_000), (60, 20, 1)])
def test_byte_repeats(odd, length, gram, hot):
    rows, docs = odd
    units = [(t or "").encode() for _, t in rows]
    want = Counter()
    for (i, _), u, gone in zip(rows, units, cut_by_hand(units, length)):
        kept = bytes(b for b, g in zip(u, gone) if not g)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i, len(u), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, suffix_array_dedup.dedup(docs, length, gram, hot).collect())) == want


def spans_by_hand(gone):
    heads = [i for i, g in enumerate(gone) if g and not (i and gone[i - 1])]
    return tuple((i, (gone[i:] + [False]).index(False)) for i in heads)


def test_kept_texts_and_spans(odd, documents):
    rows, docs = odd
    words, raw = [WORD.findall(t or "") for _, t in rows], [(t or "").encode() for _, t in rows]
    want, want_bytes = Counter(), Counter()
    for (i, _), u, gone in zip(rows, words, cut_by_hand(words, 4)):
        want[i, len(u), " ".join(w for w, g in zip(u, gone) if not g), spans_by_hand(gone)] += 1
    for (i, _), u, gone in zip(rows, raw, cut_by_hand(raw, 60)):
        want_bytes[i, len(u), bytes(b for b, g in zip(u, gone) if not g), spans_by_hand(gone)] += 1
    got = substring_dedup.kept_texts(docs, 4, 2).collect()
    assert Counter((r.doc_id, r.n_words, r.kept, tuple(map(tuple, r.spans))) for r in got) == want
    got = suffix_array_dedup.kept_bytes(docs, 60, 20).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept), tuple(map(tuple, r.spans))) for r in got) == want_bytes
    assert sum(len(k[3]) for k in want) > 10 and sum(len(k[3]) for k in want_bytes) > 10
    assert substring_dedup.kept_texts(documents([])).count() == suffix_array_dedup.kept_bytes(documents([])).count() == 0


def test_repeated_rows_bring_their_spans_once(documents):
    texts = [" ".join(f"{mark}{i}" for i in range(k)) for mark, k in (("a", 400), ("b", 300))]
    docs = documents([(7, texts[0])] * 30 + [(None, texts[1])] * 20 + [(8, "x " + texts[1][:400])])
    units = repeats.Units(words=True, gram=2, length=4)
    runs = substring_dedup.repeated_runs(docs, units)
    places = {tuple(r) for r in runs.select("doc_id", "mark", "start").collect()}
    by_text = Counter(p[:2] for p in places)

    def sizes(data, offsets, row, start, n):
        return {"size": np.bincount(row, minlength=len(offsets) - 1)}

    found = repeats.with_covered(docs, runs, units, "size bigint", sizes).collect()
    assert Counter(r.doc_id for r in found) == {7: 30, None: 20, 8: 1}
    assert {r.size for r in found} == set(by_text.values())
    # Of a text that rows repeat, one copy is compared with the others.
    docs = docs.coalesce(1)
    few = repeats.run_rows(docs, units).where("doc_id IS NULL OR doc_id = 8").select("doc_id", "mark", "start", "n", "key").distinct()
    alone = repeats.shared_windows(docs, few.where("doc_id IS NULL"), units, by_range=False)
    assert alone.count() == 0


def test_no_rows_no_repeats(documents):
    assert substring_dedup.dedup(documents([])).count() == 0
    assert suffix_array_dedup.dedup(documents([])).count() == 0


def leaks_by_hand(rows, items):
    out = defaultdict(tuple)
    for doc, text in rows:
        own = WORD.findall((text or "").lower())
        for item, passage in items:
            want = WORD.findall((passage or "").lower())
            n = len(want)
            span = min(n, 13)
            need = span - 2 * span // 13
            for shift in range(-n + 1, len(own)):
                equal = [0 <= shift + j < len(own) and own[shift + j] == want[j] for j in range(n)]
                if n and sum(equal) >= need and any(sum(equal[k : k + span]) >= need for k in range(n - span + 1)):
                    key = (sum(equal), -shift)
                    if key > out[doc, item]:
                        out[doc, item] = key
    return {k: v for k, v in out.items() if v}


def test_leaks_with_substitutions(spark, documents):
    passage = [f"p{i}" for i in range(30)]
    changed = passage.copy()
    for at in (3, 9, 16, 22, 28):
        changed[at] = "other"
    spoiled = [w if i % 4 else "no" for i, w in enumerate(passage)]
    rows = [
        (1, "start " + " ".join(passage) + " end"), (2, "x y " + " ".join(changed).upper()), (3, " ".join(spoiled)),
        (4, " ".join(passage[:13])), (5, " ".join(passage[:12])), (6, None), (7, ""), (8, "a b c d e f g h"),
        (8, "a b c d e f g h"), (None, " ".join(passage)), (9, " ".join(passage * 3)), (10, "short one"),
    ]
    items = [(1, " ".join(passage)), (2, "A b c d e f g"), (3, "short one"), (4, None), (5, ""), (6, " ".join(passage[5:25]))]
    docs, benchmark = documents(rows), spark.createDataFrame([(*x, "z") for x in items], "item_id long, text string, mark string")
    found = decontamination.leaks(docs, benchmark)
    assert {(r.doc_id, r.item_id): (r.n_equal, -r.start) for r in found.collect()} == leaks_by_hand(rows, items)
    clean = decontamination.clean(docs, benchmark)
    assert clean.columns == docs.columns
    bad = {doc for doc, _ in leaks_by_hand(rows, items)}
    assert bad == {1, 2, 4, 5, 8, 9, 10, None}
    assert {r.doc_id for r in clean.collect()} == {3, 6, 7}
    assert decontamination.leaks(documents([]), benchmark).count() == 0
    assert decontamination.clean(docs, benchmark.limit(0)).count() == len(rows)


@pytest.mark.parametrize("lists", [1, 10_000])
def test_short_items(spark, documents, monkeypatch, lists):
    monkeypatch.setattr(decontamination, "LIST", lists)
    items = [(n, " ".join(f"i{n}x{k}" for k in range(n))) for n in (1, 2, 3, 5, 6, 7, 8, 11, 12, 13, 14)] + [(90, "a a a"), (91, "")]
    rows = []
    for n, text in items[:-2]:
        found = text.split()
        for gone in ([], [0], [n // 2], [n - 1], [0, n - 1], [n // 3, n // 2]):
            line = [w if k not in gone else "other" for k, w in enumerate(found)]
            rows += [(len(rows), "x y " + " ".join(line) + " z"), (len(rows) + 1, " ".join(line))]
        rows += [(len(rows), " ".join(found[1:])), (len(rows) + 1, " ".join(found[:-1]))]
    rows += [(900, "a a a a"), (901, "b a a"), (902, " ".join(t for _, t in items))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(documents(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id): (r.n_equal, -r.start) for r in found} == leaks_by_hand(rows, items)
    assert {i for _, i in leaks_by_hand(rows, items)} == {i for i, t in items if t}


def test_masks_fit_beside_a_substitution():
    for n in range(1, 13):
        (mask,) = decontamination.masks(n)
        for gone in range(n) if decontamination.tolerance(n) else (None,):
            assert any(gone not in {at + p for p in mask} for at in range(n - mask[-1]))


def test_leaks_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 20)
    items = spark.createDataFrame([(i, " ".join(f"q{i}{j}" for j in range(20))) for i in range(5)], "item_id long, text string")
    docs = documents([(i, "x " + " ".join(f"q{i}{j}" for j in range(20))) for i in range(7)])
    found = decontamination.leaks(docs, items).collect()
    assert sorted((r.doc_id, r.item_id, r.n_equal, r.start) for r in found) == [(i, i, 20, 1) for i in range(5)]


def test_seeds_fit_between_any_two_substitutions():
    for a in range(decontamination.WINDOW):
        for b in range(a):
            assert any(
                not {a, b} & {at + p for p in mask}
                for mask in decontamination.SEEDS for at in range(decontamination.WINDOW - mask[-1])
            )
