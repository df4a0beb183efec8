"""Words, lines and texts in the Thue-Morse order, which collide for any polynomial hash modulo a power of two."""

import hashlib
import re

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from tierlake.llm import bpe, jaccard_join, quality_rules, substring_dedup, token_counts

from .test_rows import best_count, rules_by_hand


def order(n, one, other):
    """The first n terms of the sequence, by the parity of binary digits, and their complement."""
    ones = [bin(i).count("1") & 1 for i in range(n)]
    return [(one, other)[k] for k in ones], [(other, one)[k] for k in ones]


@pytest.fixture(scope="module", params=[1024, 2048, 4096])
def pair(request):
    return tuple("".join(x) for x in order(request.param, "a", "b"))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def test_long_words_are_told_apart(spark, pair):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = frame(spark, [*pair, " ".join(pair)])
    for r in bpe.encode(docs, path, with_ids=True).collect():
        text = [*pair, " ".join(pair)][r.doc_id]
        assert r.token_ids == library.encode(text, add_special_tokens=False).ids
    sets = {r.doc_id: r.component_id for r in jaccard_join.join(docs, jaccard_join.Similarity(3, 90)).collect()}
    assert sets == {0: 0, 1: 1, 2: 2}


def test_token_counts_of_long_words(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.unigram(path)
    texts = ["".join(x) for x in order(2048, "i", "n")]
    got = [r.n_tokens for r in token_counts.token_counts(frame(spark, texts), path).orderBy("doc_id").collect()]
    assert got == [best_count(model, "▁" + t) for t in texts]


def test_long_lines_are_told_apart(spark, pair):
    text = "\n".join(pair)
    (row,) = quality_rules.repetition(frame(spark, [text])).collect()
    assert row.n_dup_lines == 0 and tuple(row)[1:7] == rules_by_hand(text)


def test_runs_of_words_are_told_apart(spark):
    one, other = (" ".join(x) for x in order(1024, "aa", "bb"))
    texts = [one + " x " + other, other + " y " + one, "plain " + one]
    word = [re.findall(r"\S+", t) for t in texts]
    windows = {}
    for d, w in enumerate(word):
        for i in range(len(w) - 34):
            windows.setdefault(tuple(w[i : i + 35]), []).append((d, i))
    gone = {(d, i + k) for places in windows.values() if len(places) > 1 for d, i in places for k in range(35)}
    for r in substring_dedup.dedup(frame(spark, texts)).collect():
        kept = " ".join(w for i, w in enumerate(word[r.doc_id]) if (r.doc_id, i) not in gone)
        assert r.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
