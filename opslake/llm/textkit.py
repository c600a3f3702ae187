"""Vectorised helpers over Arrow string columns, shared by the operators that
run NumPy inside Spark tasks. Each helper works on one Arrow batch: the bytes
of all its texts side by side, with the offset where each text begins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 16


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift / multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    size = 1
    b = np.uint64(base & 0xFFFFFFFFFFFFFFFF)
    while size < n:  # doubling: out[size:2*size] = out[:size] * base**size
        k = min(size, n - size)
        step = np.uint64(pow(int(b), size, 1 << 64))
        out[size:size + k] = out[:k] * step
        size += k
    return out


_BASE = 0x2545F4914F6CDD1D  # odd, so it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_FORWARD = _powers(_BASE, _BLOCK + 1)
_BACKWARD = _powers(_INV, _BLOCK + 1)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)


@dataclass
class Texts:
    """data: bytes of all texts; starts: n + 1 offsets; null: which texts are
    missing (they span no bytes)."""

    data: np.ndarray
    starts: np.ndarray
    null: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


def texts_of(column) -> Texts:
    """The bytes and offsets of an Arrow string column, without copying texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    n = len(column)
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    if n == 0 or off is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), null)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    view = whole[offsets[0]:offsets[-1]]
    return Texts(view, offsets - offsets[0], null)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """The words of a batch: begin and end offsets into the bytes, and for each
    text the range first[i]:first[i + 1] of its words."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def words_of(texts: Texts, is_word: np.ndarray) -> Words:
    """Maximal runs of bytes for which the 256-entry table ``is_word`` holds;
    a run never crosses from one text to the next."""
    inside = is_word[texts.data]
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(z, z, np.zeros(len(texts) + 1, np.int64))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = texts.starts[:-1][texts.starts[:-1] < n]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = texts.starts[1:][texts.starts[1:] > 0] - 1
    ends[tails] = inside[tails]
    begin = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return Words(begin, end, np.searchsorted(begin, texts.starts).astype(np.int64))


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """One 64-bit hash for each word. A word's value is a polynomial in its
    bytes, read off prefix sums of blocks, then mixed with its length."""
    n = len(data)
    out = np.zeros(len(words.begin), np.uint64)
    if not len(out):
        return out
    at = 0
    lo = 0
    while lo < len(out):
        # blocks begin at a word, so that a block's first word is whole
        at = int(words.begin[lo])
        stop = at + _BLOCK
        hi = int(np.searchsorted(words.end, stop, side="right"))
        if hi == lo:  # one word longer than a block
            out[lo] = _long_word(data[at:int(words.end[lo])])
            lo += 1
            continue
        stop = min(n, stop)
        sums = np.empty(stop - at + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTE[data[at:stop]] * _FORWARD[:stop - at], out=sums[1:])
        b = words.begin[lo:hi] - at
        e = words.end[lo:hi] - at
        out[lo:hi] = mix64((sums[e] - sums[b]) * _BACKWARD[b] + (e - b).astype(np.uint64) * _ODD)
        lo = hi
    return out


def _long_word(data: np.ndarray) -> np.uint64:
    h = np.uint64(0)
    for at in range(0, len(data), _BLOCK):
        part = data[at:at + _BLOCK]
        with np.errstate(over="ignore"):
            h = h * np.uint64(pow(_BASE, _BLOCK, 1 << 64)) + (_BYTE[part] * _FORWARD[:len(part)]).sum(dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mix64(np.array([h + np.uint64(len(data)) * _ODD], np.uint64))[0]


#: bytes outside [\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, a-z and all of a multi-byte character
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def shingles_of(hashes: np.ndarray, k: int, weights: np.ndarray | None = None):
    """Sorted distinct k-word shingles of one text as 64-bit hashes; a text of
    fewer words has one shingle, the whole sequence; one without words has none.
    With ``weights`` of the words, also the sum of each shingle's."""
    n = len(hashes)
    if n == 0:
        return hashes if weights is None else (hashes, weights)
    span = min(n, k)
    out = np.full(n - span + 1, span, np.uint64)
    for i in range(span):
        out = mix64(out * _ODD + hashes[i:n - span + 1 + i])
    if weights is None:
        out.sort()
        return out[np.concatenate(([True], out[1:] != out[:-1]))]
    total = weights[:n - span + 1].copy()
    for i in range(1, span):
        total += weights[i:n - span + 1 + i]
    out, at = np.unique(out, return_index=True)
    return out, total[at]


def batch_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the batch's words (A-Z lower-cased, apart at white space), and the range of each text."""
    data = lower_ascii(texts.data)
    words = words_of(Texts(data, texts.starts, texts.null), NOT_SPACE)
    return hash_words(data, words), words.first


def batch_shingles(texts: Texts, k: int) -> list[np.ndarray]:
    hashes, first = batch_words(texts)
    return [shingles_of(hashes[first[i]:first[i + 1]], k) for i in range(len(texts))]


def slices(batches, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of ``column`` hold about ``most`` bytes
    in each (a longer text is a batch of its own)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        starts = texts_of(batch.column(column)).starts
        at = 0
        while at < n:
            to = int(np.searchsorted(starts, starts[at] + most, side="right")) - 1
            to = min(n, max(to, at + 1))
            yield batch.slice(at, to - at)
            at = to
