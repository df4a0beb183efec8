"""Operators that look at one text at a time: rules, tokens, encodings, scores."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tierlake.llm import bpe, quality_classifier, quality_rules, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rules_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def test_rules_match_by_hand(odd):
    rows, docs = odd
    found = quality_rules.repetition(docs)
    got = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in found.collect()
    )
    assert got == Counter((i, *rules_by_hand(t)) for i, t in rows)
    for r in found.collect():
        assert not (r.kept and r.base_failed)


def test_shares_count_characters_in_repeats():
    text = ("a b c d e f " * 2 + " ".join(f"x{i}" for i in range(30))).encode()
    made = quality_rules._measure(np.frombuffer(text, np.uint8), np.array([0, len(text)]), quality_rules.Rules())
    chars = len(text.replace(b" ", b""))
    assert made["share_5"][0] == pytest.approx(12 / chars)
    assert made["share_10"][0] == 0


def test_keep_filters_and_keeps_columns(odd, documents):
    rows, docs = odd
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    good = {r.doc_id for r in quality_rules.repetition(docs).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good
    assert 8 not in good and 13 not in good and 4 in good
    assert quality_rules.keep(documents([])).count() == 0


@pytest.fixture(scope="module")
def library():
    path = public_tokenizers.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_encoding_equals_the_library(odd, library):
    path, tokenizer = library
    rows, docs = odd
    want = Counter()
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        line = " ".join(map(str, ids))
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), tuple(ids)] += 1
    got = Counter(tuple(r[:4]) + (tuple(r.token_ids),) for r in bpe.encode(docs, path, with_ids=True).collect())
    assert got == want


def test_encoding_of_random_texts(spark, library):
    path, tokenizer = library
    pick = np.random.default_rng(3)
    letters = list("abcdeisTRE'\n\t <|>.,!0٣ªéσΣİßẞ日́ﬁ \u0085\x1c") + ["<|endoftext|>", "the", "ing"]
    texts = ["".join(pick.choice(letters, pick.integers(1, 40))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.encode(docs, path, with_ids=True).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.token_ids == ids
        assert bpe.decode(ids, path) == tokenizer.decode(ids, skip_special_tokens=False)


def test_ids_decode_on_spark(spark, library):
    path, tokenizer = library
    lists = [[], None, [5, 900, 17], list(range(49_000)), [0] * 3]
    rows = spark.createDataFrame([(x, "d") for x in lists], "ids array<int>, decoded_x string")
    got = [r.text for r in bpe.decoded(rows.coalesce(1), path, "ids", "text").collect()]
    assert got == [None if x is None else tokenizer.decode(x, skip_special_tokens=False) for x in lists]


def best_count(model, word):
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(1, len(word) + 1):
        size = len(word[i - 1].encode())
        options = [(best[i - 1][0] + size * model.byte_score, -best[i - 1][1] - size)]
        options += [
            (best[a][0] + model.score[word[a:i]], -best[a][1] - 1) for a in range(i) if word[a:i] in model.score
        ]
        top = max(options)
        best[i] = top[0], -top[1]
    return best[-1][1]


def test_token_counts_equal_word_by_word(odd):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.unigram(path)
    rows, docs = odd
    want = Counter()
    for i, text in rows:
        found = WORD.findall(text or "")
        want[i, len(found), sum(best_count(model, "▁" + w) for w in found)] += 1
    assert Counter(map(tuple, token_counts.token_counts(docs, path).collect())) == want


def test_classifier_learns_and_scores_everything(spark, odd):
    from pyspark.sql import functions as F

    made = [(i, f"{'GOOD calm text' if i % 2 else 'bad!! bad!! ###'} word{i} more{i % 7}") for i in range(200)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(150)] + [(150, None), (151, 7), (3, 0), (None, 1)], "doc_id long, quality int")
    weights = quality_classifier.train(docs, labels, F.col("doc_id") % 5 != 0, "quality")
    out = quality_classifier.score(docs, weights).collect()
    assert all(r.predicted == r.doc_id % 2 for r in out if r.doc_id >= 150)
    rows, odd_docs = odd
    scores = quality_classifier.score(odd_docs, weights).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    none = quality_classifier.train(docs, labels.limit(0), F.lit(True), "quality")
    assert {r.score for r in quality_classifier.score(docs, none).collect()} == {0.5}


def test_held_out_accuracy(spark):
    from tierlake.llm.queries import op5_quality_classifier

    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in op5_quality_classifier(spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.9
