"""Words and hashes of whole Arrow batches of text, in numpy.

Words are runs of bytes other than ASCII white space. A word's hash is a
polynomial of its bytes modulo 2^64, taken from running sums, and then mixed;
so a batch needs a fixed number of array operations and no loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that are worked on at once; arrays of 8 bytes a byte stay small.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Separators of plain words: ASCII bytes other than letters and digits.
PLAIN = np.zeros(256, bool)
PLAIN[:128] = [not chr(b).isalnum() for b in range(128)]
_powers: list[np.ndarray] = []


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finalizer, a bijection that spreads all bits."""
    with np.errstate(over="ignore"):
        x = x + U64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


_BYTE = mix(np.arange(256, dtype=U64), 11)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            size = max(n, CHUNK + 4096)
            _powers[:] = [np.cumprod(np.full(size, x, U64)) for x in (_BASE, pow(_BASE, -1, 2**64))]
    return _powers[0], _powers[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the n + 1 offsets of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def _segments(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK bytes that begin at a text or right after a separator."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(end, at + CHUNK)
        if to < end:
            i = int(np.searchsorted(offsets, to, "right")) - 1
            if offsets[i] > at:
                to = int(offsets[i])
            else:  # within one long text
                stop = int(offsets[i + 1])
                while to < stop:
                    gap = np.flatnonzero(gaps[data[to : min(stop, to + CHUNK)]])
                    if len(gap):
                        to += int(gap[0]) + 1
                        break
                    to = min(stop, to + CHUNK)
        yield at, to
        at = to


def tokens(texts: pa.Array, lower: bool = True, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, first bytes and ends of all words, and the n + 1 offsets of each text's words.

    lower: A-Z as a-z. gaps: the bytes that separate words.
    """
    data, offsets = buffers(texts)
    table, hashes, begins, ends_at = _BYTE_LOWER if lower else _BYTE, [], [], []
    for a, b in _segments(data, offsets, gaps):
        part = data[a:b]
        n, inside = b - a, ~gaps[part]
        first = np.zeros(n + 1, bool)
        first[0] = first[n] = True
        first[offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a] = True
        starts = np.flatnonzero(inside & (first[:-1] | ~np.concatenate(([False], inside[:-1]))))
        ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False]))))
        power, inverse = _power_tables(n)
        with np.errstate(over="ignore"):
            sums = np.cumsum(table[part] * power[:n])
            before = np.where(starts > 0, sums[starts - 1], U64(0))
            hashes.append(mix((sums[ends] - before) * inverse[starts] + (ends - starts).astype(U64)))
        begins.append(starts + a)
        ends_at.append(ends + a + 1)
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begin = np.concatenate(begins)
    return np.concatenate(hashes), begin, np.concatenate(ends_at), np.searchsorted(begin, offsets)


def prefixes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the first n bytes of words, A-Z as a-z; words that are shorter get a hash of no meaning."""
    total = np.full(len(begin), n, U64)
    most = max(0, len(data) - 1)
    with np.errstate(over="ignore"):
        for k in range(n):
            total = mix(total ^ _BYTE_LOWER[data[np.minimum(begin + k, most)]], 201)
    return total


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words between ASCII white space, and the n + 1 offsets of each text's words."""
    hashes, _, _, at = tokens(texts, lower)
    return hashes, at


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 63-bit hashes of each text's word shingles, and their n + 1 offsets.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    hashes, at = word_hashes(texts)
    total = np.zeros(max(0, len(hashes) - words + 1), U64)
    with np.errstate(over="ignore"):
        for j in range(words):
            total += mix(hashes[j : j + len(total)], 101 + j)
        shingles = mix(total) >> U64(1)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= words:
                x = np.sort(shingles[a : b - words + 1])
                sets.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
            elif b > a:
                x = np.zeros(1, U64)
                for j in range(b - a):
                    x += mix(hashes[a + j : a + j + 1], 101 + j)
                sets.append(mix(x, 1000 + b - a) >> U64(1))
            else:
                sets.append(np.zeros(0, U64))
    sizes = np.array([len(x) for x in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), np.concatenate(([0], np.cumsum(sizes)))


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
