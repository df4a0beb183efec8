"""Vectorised text helpers for Arrow batches: words, rolling hashes and runs over whole texts.

Texts stay in Arrow's byte buffers. A batch is worked on in chunks of documents of about CHUNK bytes, so
scratch memory depends on the longest single text, not on the batch. Words are told apart by their bytes. Hashes of
sequences are polynomials modulo the prime 2**61 - 1 with a final mix; a word's hash is its xxh3. All are the same in
every process. (Modulo a power of two, texts that follow the Thue-Morse order would collide for any base.)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

CHUNK = 1 << 20
U64 = np.uint64
PRIME = U64((1 << 61) - 1)
BASE = 0x1A35E6C1D9F0B47D
LOW = U64((1 << 32) - 1)
BLOCK = 1 << 14
BYTE_VALUES = np.random.default_rng(20240229).integers(1, (1 << 61) - 1, 256, dtype=U64)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & PRIME) + (x >> U64(61))
    return np.minimum(x, x - PRIME)  # below PRIME the difference wraps round to a large number


def times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """a * b modulo PRIME, of values below PRIME; in blocks, so that scratch values stay in the processor's cache."""
    if len(a) <= BLOCK:
        return _times(a, b)
    out = np.empty(len(a), U64)
    for i in range(0, len(a), BLOCK):
        out[i : i + BLOCK] = _times(a[i : i + BLOCK], b[i : i + BLOCK] if b.ndim else b)
    return out


def _times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """By halves of 32 bits."""
    a_high, a_low, b_high, b_low = a >> U64(32), a & LOW, b >> U64(32), b & LOW
    middle = a_high * b_low
    middle += a_low * b_high
    low = a_low * b_low
    out = (a_high * b_high) << U64(3)  # 2**64 is 8
    out += middle >> U64(29)
    out += (middle & U64((1 << 29) - 1)) << U64(32)
    out += low & PRIME
    out += low >> U64(61)
    return _reduced(out)


class _Powers:
    """Powers of BASE and of its inverse modulo PRIME, as many as were asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def need(self, n: int) -> None:
        prime = int(PRIME)
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, times(self.up, U64(pow(BASE, k, prime)))])
            self.down = np.concatenate([self.down, times(self.down, U64(pow(BASE, -k, prime)))])


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash reads the hash of any span of the values."""
    _POWERS.need(len(values) + 1)
    out = np.zeros(len(values) + 1, U64)
    terms = times(_reduced(values), _POWERS.up[: len(values)])
    high = _reduced(np.cumsum(terms >> U64(32)))
    high = ((high & U64((1 << 29) - 1)) << U64(32)) | (high >> U64(29))
    out[1:] = _reduced(high + _reduced(np.cumsum(terms & LOW)))
    return out


def byte_sums(data: np.ndarray) -> np.ndarray:
    return sums(BYTE_VALUES[data])


def _between(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    difference = high - low
    return np.minimum(difference, difference + PRIME)


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], the same wherever the span stands; its length counts too."""
    return mix(times(_between(prefix[end], prefix[start]), _POWERS.down[start]) + mix((end - start).astype(U64)))


def windows(prefix: np.ndarray, length: int) -> np.ndarray:
    """span_hash of every window of so many values."""
    n = len(prefix) - length
    if n <= 0:
        return np.zeros(0, U64)
    return mix(times(_between(prefix[length:], prefix[:n]), _POWERS.down[:n]) + mix(np.array([length], U64)))


class Words:
    """The words of consecutive texts: byte spans, hashes, and the text (row) each belongs to.

    cuts[i] also ends a word after byte i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None):
        self.data, self.offsets = data, offsets
        gap = SEPARATOR[data]
        first, last = np.ones(len(data), bool), np.ones(len(data), bool)
        first[1:], last[:-1] = gap[:-1], gap[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        first[inner] = True
        last[inner - 1] = True
        if cuts is not None and len(data):
            first[1:] |= cuts
            last[:-1] |= cuts
        self.gap = gap
        self.start = np.flatnonzero(first & ~gap)
        self.end = np.flatnonzero(last & ~gap) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.count)

    def numbers(self) -> tuple[pa.Array, np.ndarray]:
        """The distinct words, told apart by their bytes, and for each word the number of its distinct one."""
        size = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=size[1:])
        raw = np.ascontiguousarray(self.data[~self.gap])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(size), pa.py_buffer(raw)])
        # The system's allocator gives scratch memory back; Arrow's own keeps it.
        coded = pc.dictionary_encode(words, memory_pool=pa.system_memory_pool())
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def hashes(self) -> np.ndarray:
        distinct, number = self.numbers()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), U64, len(distinct))[number]


def pieces_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """xxh3 of byte spans, for few and long ones."""
    raw = memoryview(np.ascontiguousarray(data))
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())), U64, len(start))


def distinct_words(words: Words) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces of a chunk and, for each piece, the number of its distinct one."""
    distinct, number = words.numbers()
    return distinct.to_pylist(), number


def inside(row: np.ndarray, length: int) -> np.ndarray:
    """Whether the window of so many words at each start stays within one text."""
    return row[: len(row) - length + 1] == row[length - 1 :] if len(row) >= length else np.zeros(0, bool)


def again(row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key stands more than once in its row."""
    if not len(key):
        return np.zeros(0, bool)
    own = key ^ mix(row.astype(U64) + U64(1))
    order = np.argsort(own)
    same = own[order[1:]] == own[order[:-1]]
    out = np.zeros(len(key), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in a span."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:-1]) > 0


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the flags between consecutive bounds."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of whole texts; null counts as empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def map_texts(
    df: DataFrame, text: str, keep: list[str], schema: str,
    work: Callable[[np.ndarray, np.ndarray], dict[str, object]],
) -> DataFrame:
    """One output row per row: the kept columns and what work(bytes, offsets) returns for a chunk of texts.

    schema has the kept columns first, under whatever names, then work's columns by its own names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, offsets in chunks(batch.column(0)):
                made = work(data, offsets)
                columns = [batch.column(i + 1).slice(at, to - at) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    columns + [x if isinstance(x, pa.Array) else pa.array(x) for x in made.values()],
                    names=[x.split()[0] for x in schema.split(", ")],
                )

    return df.select(text, *keep).mapInArrow(run, schema)
