"""Numpy helpers that tokenise and hash whole Arrow batches of UTF-8 text.

The functions work on the raw bytes of a text column, a few hundred kilobytes
at a time, so memory stays bounded by the slice size or, if that is larger,
by the longest single text. Nothing here knows about Spark plans; the helpers
run inside ``mapInArrow`` tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that linear sums become uniform."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Words longer than this many bytes are hashed one by one.
LONG_WORD = 512


def lower_ascii() -> np.ndarray:
    """Byte table that lower-cases A-Z and leaves every other byte."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_classes() -> np.ndarray:
    """Byte classes for words of ``[^\\x20\\x09-\\x0D]+``: 0 between words, 1 in them."""
    t = np.ones(256, dtype=np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = 0
    return t


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of whole rows of about ``limit`` bytes.

    Yields (first row, past the last row, bytes, offsets); offsets has one
    entry more than the run has rows and starts at 0. A null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + rows + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, raw[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def tokens(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray,
           fold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Split a run of texts into tokens and hash each.

    A token is a longest run of bytes of one non-zero class inside one text.
    ``fold`` maps bytes before hashing (case folding). Returns (hash of each
    token, its start byte, index of each text's first token with a closing
    entry).
    """
    n = len(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    kind = classes[data]
    edge = np.empty(n, dtype=bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    inner = offsets[:-1]
    edge[inner[inner < n]] = True
    runs = np.flatnonzero(edge)
    sizes = np.diff(runs, append=n)
    keep = kind[runs] > 0
    starts, sizes = runs[keep], sizes[keep]
    padded = np.zeros(n + 8, dtype=np.uint8)
    np.take(fold, data, out=padded[:n])
    return _hash_runs(padded, starts, sizes), starts, np.searchsorted(starts, offsets)


_TAIL = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [_MASK], dtype=_U)


def _hash_runs(padded: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of each byte run, eight bytes a step; ``padded`` ends in 8 spare bytes."""
    eights = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    total = mix64(eights[starts] & _TAIL[np.minimum(sizes, 8)])
    total += sizes.astype(_U) * _U(0x632BE59BD9B4E019)
    more = np.flatnonzero(sizes > 8)
    step = 8
    while len(more) and step < LONG_WORD:
        rest = np.minimum(sizes[more] - step, 8)
        total[more] = mix64(total[more]) + (eights[starts[more] + step] & _TAIL[rest]) * _U(0x9E3779B97F4A7C15)
        step += 8
        more = more[sizes[more] > step]
    for i in more:
        run = padded[starts[i]:starts[i] + sizes[i]].tobytes()
        total[i] = int.from_bytes(hashlib.blake2b(run, digest_size=8).digest(), "little")
    return mix64(total)


def _odd(seed: int, n: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed & _MASK)) | _U(1)


def ngrams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` tokens (len - k + 1 of them, across texts)."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, _U)
    odd = _odd(seed * 1000 + k, k)
    total = hashes[:m] * odd[0]
    for j in range(1, k):
        total = total + hashes[j:j + m] * odd[j]
    return mix64(total + _U(k))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (np.unique's hash table is slower on long texts)."""
    values = np.sort(values)
    fresh = np.empty(len(values), dtype=bool)
    fresh[:1] = True
    np.not_equal(values[1:], values[:-1], out=fresh[1:])
    return values[fresh]


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of every text.

    Words are runs outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased. A text
    of fewer than ``k`` words has its whole sequence as its one shingle; one
    without words has the empty set.
    """
    fold, classes = lower_ascii(), space_classes()
    for first, last, data, offsets in slices(column):
        hashes, _, firsts = tokens(data, offsets, classes, fold)
        grams = ngrams(hashes, k)
        for row in range(last - first):
            a, b = int(firsts[row]), int(firsts[row + 1])
            if b - a >= k:
                yield first + row, distinct(grams[a:b - k + 1])
            elif b > a:
                yield first + row, ngrams(hashes[a:b], b - a, seed=7)
            else:
                yield first + row, np.zeros(0, _U)
