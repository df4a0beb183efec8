"""Unigram token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word (no ASCII white space) with the word-start sign of the vocabulary in front. The distinct
pre-tokens of a chunk are visited in sorted order, a depth-first walk of their trie, so the forward score of a
shared prefix (best sum of piece scores that spell it) is computed once; the number of pieces is kept at the
terminal nodes. Among equal scores fewer pieces win. A character that no piece covers costs one byte piece for
each of its UTF-8 bytes.

The vocabulary is a sentencepiece file under a path that every executor has; its pieces, in file order, get the
scores of Zipf's law, -log(rank + 2), and byte pieces the lowest. No shuffle: one pass over the texts.

Defined cases: a null or empty text has no pre-tokens and no tokens; an empty table gives an empty result;
repeated rows get equal rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .text import Words, distinct_words, map_texts

START = "▁"
CACHE_WORDS = 400_000


class Unigram:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        self.score = {p: -math.log(rank + 2) for rank, p in enumerate(pieces)}
        self.byte_score = -math.log(len(pieces) + 2)
        self.longest = max(map(len, pieces))
        self.known: dict[bytes, int] = {}

    def count_sorted(self, words: list[str]) -> list[int]:
        """Pieces of the best segmentation of each of the distinct words, which come in ascending order."""
        out, before = [], ""
        best, count = [0.0], [0]  # of each prefix of the word before
        score, longest = self.score.get, self.longest
        for word in words:
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                size = len(word[i - 1].encode("utf-8", "replace"))
                top, pieces = best[i - 1] + size * self.byte_score, count[i - 1] + size
                for at in range(max(0, i - longest), i):
                    own = score(word[at:i])
                    if own is not None:
                        own += best[at]
                        if own > top or (own == top and count[at] < pieces - 1):
                            top, pieces = own, count[at] + 1
                best.append(top)
                count.append(pieces)
            before = word
            out.append(count[len(word)])
        return out

    def counts(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        fresh = {START + w.decode("utf-8", "replace"): w for w in words if w not in self.known}
        ordered = sorted(fresh)
        for word, n in zip(ordered, self.count_sorted(ordered)):
            self.known[fresh[word]] = n
        return np.array([self.known[w] for w in words], np.int64)


@lru_cache(maxsize=2)
def unigram(path: str) -> Unigram:
    return Unigram(path)


def _count(path: str, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    words = Words(data, offsets)
    distinct, number = distinct_words(words)
    total = np.zeros(len(number) + 1, np.int64)
    if len(number):
        np.cumsum(unigram(path).counts(distinct)[number], out=total[1:])
    return {"n_pretokens": words.count.astype(np.int64), "n_tokens": np.diff(total[words.bounds])}


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, number of pre-tokens and number of tokens."""
    schema = f"{id_column} {docs.schema[id_column].dataType.simpleString()}, n_pretokens bigint, n_tokens bigint"
    return map_texts(docs, text, [id_column], schema, lambda data, offsets: _count(path, data, offsets))
