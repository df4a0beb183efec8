"""BPE encoding and decoding of whole texts by a prefix-sharing trie traversal.

A text is split at ASCII white space, which no pre-token crosses. The distinct words of a chunk give distinct
pre-tokens, and those are visited in sorted order, which is a depth-first walk of their trie: going from one
pre-token to the next keeps the states of the shared prefix. The state of a prefix is its last token. A prefix
of length i ends with token t exactly if t is a suffix of it and the pair (last token of the rest, t) is stable,
that is, BPE over the two tokens' symbols gives the two tokens again. So each distinct prefix is worked out
once, and an encoding is read by following last tokens back.

Decoding goes from lists of ids: each id is looked up in the vocabulary's tokens, which are joined as the file says (no
decoder: by a space). decoded() does so for a column of any table; encode() takes its digest from what its ids decode to.

The vocabulary is a `tokenizers` JSON file of BPE kind with word ends, found on every executor under the given
path. It is parsed once per Python worker. There is no shuffle.

Defined cases: a null or empty text has no tokens and decodes to the empty text; literal special tokens in a
text are their own ids; equal texts get equal rows; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import LOWER, Words, distinct_words, map_texts

#: Distinct words whose encodings a Python worker keeps between chunks; then it starts anew.
CACHE_WORDS = 400_000
#: Added to a byte that ends a word.
END = 256


def byte_letters() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: each printable Latin-1 byte is itself, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a file; symbols are byte strings, with a mark at a word's end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        splits = [x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        self.words = regex.compile(splits[0])
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        letters = byte_letters()
        ids = model["vocab"]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        #: (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            self.merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
        #: Tokens by their bytes, inside a word and at its end.
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        self.symbols: dict[int, list[int]] = {}
        single = {b: (ids[c], ids[c + self.mark]) for c, b in letters.items()}
        for token, i in ids.items():
            ends = token.endswith(self.mark) and len(token) > len(self.mark)
            raw = bytes(letters[c] for c in (token[: -len(self.mark)] if ends else token))
            (self.final if ends else self.inner)[raw] = i
            self.symbols[i] = [single[b][0] for b in raw[:-1]] + [single[raw[-1]][ends]]
        # A token that BPE does not make of its own symbols is in no encoding.
        for table in (self.inner, self.final):
            for raw in [raw for raw, i in table.items() if self.merge(self.symbols[i]) != [i]]:
                del table[raw]
        self._link()
        self.pairs: dict[int, bool] = {}
        self.word_cache: dict[bytes, tuple[int, str, str]] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Plain BPE: the pair of lowest rank first, the leftmost of equals."""
        out = list(symbols)
        while len(out) > 1:
            rank, at, made = min(
                ((*self.merges[p], i)[::2] + (self.merges[p][1],) for i, p in enumerate(zip(out, out[1:])) if p in self.merges),
                default=(None, 0, 0),
            )
            if rank is None:
                break
            out[at : at + 2] = [made]
        return out

    def stable(self, left: int, right: int) -> bool:
        key = left << 20 | right
        if (known := self.pairs.get(key)) is None:
            known = self.pairs[key] = self.merge(self.symbols[left] + self.symbols[right]) == [left, right]
        return known

    def _link(self) -> None:
        """Suffix automaton of the tokens: a state is the longest suffix read that starts a token.

        A symbol is a byte, plus END at a word's end. ends[state] has (length, token) of the tokens that are
        suffixes, longest first.
        """
        self.next: dict[int, int] = {}
        self.ends: list[tuple[tuple[int, int], ...]] = [()]
        self.fall = [0]
        depth = [0]
        own: dict[int, tuple[int, int]] = {}
        for table, mark in ((self.inner, 0), (self.final, END)):
            for raw, token in table.items():
                state = 0
                for symbol in [*raw[:-1], raw[-1] + mark]:
                    key = state << 9 | symbol
                    if key not in self.next:
                        self.next[key] = len(depth)
                        depth.append(depth[state] + 1)
                        self.fall.append(0)
                        self.ends.append(())
                    state = self.next[key]
                own[state] = (len(raw), token)
        edges = sorted(self.next.items(), key=lambda x: depth[x[1]])
        for key, state in edges:
            before, symbol = key >> 9, key & 511
            if before:
                self.fall[state] = self.step(self.fall[before], symbol)
            self.ends[state] = ((own[state],) if state in own else ()) + self.ends[self.fall[state]]
        self.tree_edges = len(edges)

    def step(self, state: int, symbol: int) -> int:
        at = state
        while (to := self.next.get(at << 9 | symbol)) is None and at:
            at = self.fall[at]
        return to or 0

    def encode_sorted(self, words: list[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """The ids of each of the distinct words, which come in ascending order."""
        move, ends, step, pairs, stable = self.next.get, self.ends, self.step, self.pairs, self.stable
        states = [0]  # states[i], last[i], size[i]: of the prefix of length i
        last = [0]  # its last token
        size = [0]  # that token's length in bytes
        before = b""
        for word in words:
            n, shared, most = len(word), 0, min(len(before), len(word), len(last))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            # The states of the last word's inner prefixes go up to its length less one.
            shared = min(shared, len(last) - 1, n - 1)
            del states[shared + 1 :], last[shared + 1 :], size[shared + 1 :]
            state = states[shared]
            for i in range(shared + 1, n + 1):
                symbol = word[i - 1] + (END if i == n else 0)
                if (to := move(state << 9 | symbol)) is None:
                    to = step(state, symbol)
                state = to
                for length, token in ends[state]:
                    if length == i:
                        break
                    left = last[i - length]
                    if (fits := pairs.get(left << 20 | token)) is None:
                        fits = stable(left, token)
                    if fits:
                        break
                if i < n:
                    states.append(state)
                    last.append(token)
                    size.append(length)
            ids = [token]
            at = n - length
            while at:
                ids.append(last[at])
                at -= size[at]
            before = word
            yield word, ids[::-1]

    def pieces(self, word: str) -> list[bytes | int]:
        """Pre-tokens, as bytes, and special tokens, as ids, of a word without ASCII white space."""
        out: list[bytes | int] = []
        for part in self.special.split(word) if "<" in word else (word,):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                # Lower case goes letter by letter: no final sigma.
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out += [x.encode() for x in self.words.findall(plain)]
        return out

    def encode_words(self, words: list[bytes]) -> list[tuple[bytes, str]]:
        """Ids, of four bytes each, and ids as text, of each distinct word."""
        cache = self.word_cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        fresh = {w: self.pieces(w.decode("utf-8", "replace")) for w in words if w not in cache}
        plain = sorted({p for parts in fresh.values() for p in parts if isinstance(p, bytes)})
        known = dict(self.encode_sorted(plain))
        for word, parts in fresh.items():
            ids = [i for p in parts for i in (known[p] if isinstance(p, bytes) else (p,))]
            cache[word] = array("i", ids).tobytes(), " ".join(map(str, ids))
        return [cache[w] for w in words]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


#: ASCII letters, and ASCII marks that stand in a pre-token of their own kind only: between the two a word can be cut.
#: The apostrophe is in contractions, and <|> in special tokens.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN = np.zeros(256, bool)
SIGN[list(b'!"#$%&()*+,-./:;=?@[]^`{}~')] = True


def _encode(path: str, data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
    if not (data == ord("<")).any():
        data = LOWER[data]
    words = Words(data, offsets, (LETTER[data[:-1]] & SIGN[data[1:]]) | (SIGN[data[:-1]] & LETTER[data[1:]]))
    distinct, number = distinct_words(words)
    made = vocabulary(path).encode_words(distinct)
    ids, lines = [x[0] for x in made], [x[1] for x in made]
    count = np.array([len(x) // 4 for x in ids], np.int64)
    flat = np.frombuffer(b"".join(ids), np.int32)
    # The ids of all words in a row: each word's stretch of the distinct words' ids.
    size = count[number]
    end = np.cumsum(size)
    first = (np.cumsum(count) - count)[number]
    all_ids = flat[np.repeat(first - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
    bounds = np.append(0, end)[words.bounds]
    empty = count == 0
    digests = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        own = number[a:b]
        own = (own[~empty[own]] if empty.any() else own).tolist()
        digests.append(hashlib.sha256(" ".join([lines[i] for i in own]).encode()).hexdigest())
    return {
        "n_tokens": pa.array(np.diff(bounds)), "ids_sha256": pa.array(digests, pa.string()),
        "token_ids": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(all_ids)),
    }


@lru_cache(maxsize=2)
def tokens(path: str) -> pa.Array:
    """The token of each id, by its place."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    known = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([known.get(i) for i in range(max(known) + 1)], pa.large_string())


def _decode(path: str, lists: pa.ListArray) -> pa.Array:
    """The text of each list of ids; null of a null list."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    bounds = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int64))
    words = pa.LargeListArray.from_arrays(bounds, tokens(path).take(lists.flatten()))
    return pc.if_else(lists.is_valid(), pc.binary_join(words, pa.scalar(" ", pa.large_string())), None).cast(pa.string())


def decoded(rows: DataFrame, path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """The rows with a column of the text that their ids decode to; a null list stays null, an empty one is ''."""
    at, names = rows.columns.index(ids), [*rows.columns, into]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {into} string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _decode(path, batch.column(at))], names=names)

    return rows.mapInArrow(run, schema)


def encode(
    docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per document: the kept columns, number of tokens, digests of ids and of the decoded text, and the ids.

    The output columns n_tokens, ids_sha256, decoded_sha256 and token_ids must not be among the kept ones.
    """
    keep = ["doc_id"] if keep is None else keep
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", n_tokens bigint, ids_sha256 string, token_ids array<int>, decoded string"

    def work(data: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        # Decoded in the same Python worker: a second one beside it would hold the vocabulary again.
        made = _encode(path, data, offsets)
        return made | {"decoded": _decode(path, made["token_ids"])}

    made = map_texts(docs, text, keep, schema, work)
    return made.select(
        *keep, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), *["token_ids"] * with_ids
    )


def decode(ids: list[int], path: str) -> str:
    """The text of one list of ids, as decoded() has it for a column."""
    return " ".join(tokens(path).take(pa.array(ids, pa.int32())).to_pylist())
