"""Word and byte hashing over Arrow string columns, vectorised with numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z are lower-cased.
Its 64-bit hash is a polynomial over per-byte random values, taken from running sums, then
mixed; equal words have equal hashes on every executor and in every run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_NOT_ALNUM = np.ones(256, dtype=bool)
_NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_BYTE_LOWER = _BYTE[_LOWER]
BLOCK_BYTES = 1 << 20  # working arrays take about fifty times that


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES // 4)
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[name] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def running_sums(data: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """S[i] = sum of values[data[j]] * BASE**j over j < i, modulo 2**64."""
    out = np.empty(len(data) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values[data] * powers("base", _BASE, len(data)), dtype=np.uint64, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] from running_sums(data); independent of the position."""
    inverse = powers("inverse", _INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def gram_hashes(sums: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n bytes from every place, equal to span_hashes(sums, i, i + n)."""
    places = max(0, len(sums) - n)
    inverse = powers("inverse", _INVERSE, len(sums))
    return mix((sums[n:] - sums[:places]) * inverse[:places] + np.uint64(n))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, row offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES):
    """Row ranges of about ``size`` bytes each, so that working arrays stay small."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every word of rows laid end to end; ``space`` marks the bytes between words."""
    word = ~space[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    starts_of_rows = offsets[:-1][offsets[:-1] < len(data)]
    first[starts_of_rows] = word[starts_of_rows]
    ends_of_rows = offsets[1:][offsets[1:] > 0] - 1
    last[ends_of_rows] = word[ends_of_rows]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words_of(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, word offsets by row) of rows laid end to end."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    start, end = word_spans(data, offsets, space)
    return span_hashes(running_sums(data, _BYTE_LOWER), start, end), np.searchsorted(start, offsets)


def word_blocks(column: pa.Array, space: np.ndarray = _SPACE):
    """Yields (first row, last row + 1, word hashes, word offsets) for a string column."""
    data, offsets = bytes_of(column)
    for a, b in blocks(offsets):
        part = offsets[a:b + 1]
        yield a, b, *words_of(data[part[0]:part[-1]], part - part[0], space)


def plain_word_blocks(column: pa.Array):
    """As word_blocks(), with every ASCII character but letters and digits between words."""
    return word_blocks(column, _NOT_ALNUM)


def hash_word(word: str) -> int:
    """The hash of one word, as word_blocks() gives it."""
    return int(next(word_blocks(pa.array([word])))[2][0])


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of one row's words; fewer words make
    one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        k = n
    acc = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        acc = mix(acc * np.uint64(_BASE) + words[i:n - k + 1 + i])
    return np.unique(acc)
