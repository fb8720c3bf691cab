"""Distinct word shingles of many texts at once, as 64-bit hashes in numpy.

Words are lower-cased in A-Z only and separated by space, tab, newline, vertical tab, form feed and
carriage return. The text of an Arrow batch is hashed as one byte array in slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text hashed together; a longer text is hashed by itself, slice by slice.
SLICE_BYTES = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20_240_611).integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_HASH = _BYTES[_LOWER]
_BYTE_HASH[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.random.default_rng(7).integers(1, 2 ** 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the n + 1 offsets of its texts; nulls are empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(texts) else data[:0], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the n + 1 offsets of the texts' words."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = solid[inner]  # a word never crosses into the next text
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE_BYTES)))
        lo, hi = int(starts[at]), int(starts[upto]) if upto < len(starts) else len(data)
        begin = starts[at:upto] - lo
        lengths = np.diff(np.append(begin, hi - lo))
        place = np.arange(hi - lo) - np.repeat(begin, lengths)
        powers = np.multiply.accumulate(np.full(int(place.max()) + 1, _BASE))
        hashes[at:upto] = np.add.reduceat(_BYTE_HASH[data[lo:hi]] * powers[place], begin)
        at = upto
    return mixed(hashes), np.searchsorted(starts, offsets)


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from, to, data, offsets)`` over runs of texts of bounded size."""
    data, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        upto = min(upto, len(texts))
        yield at, upto, data[offsets[at]:offsets[upto]], offsets[at:upto + 1] - offsets[at]
        at = upto


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes text by text, and the offsets of the texts' sets.

    A text of fewer than ``n`` words has its whole sequence as its one shingle, without words none.
    """
    hashes, word_offsets = words(data, offsets)
    counts = np.diff(word_offsets)
    total = len(hashes)
    long = np.maximum(counts - n + 1, 0)
    brief = (counts > 0) & (counts < n)
    sizes = long + brief
    begin = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) + np.repeat(word_offsets[:-1] - begin, sizes)
    out = np.zeros(len(at), dtype=np.uint64)
    reach = np.repeat(np.minimum(counts, n), sizes)
    for i in range(n):
        there = reach > i
        out[there] += hashes[np.minimum(at + i, total - 1)[there]] * _PLACES[i]
    out = mixed(out + reach.astype(np.uint64) * _BASE)
    doc = np.repeat(np.arange(len(counts)), sizes)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    out, doc = out[new], doc[new]
    return out, np.searchsorted(doc, np.arange(len(counts) + 1))


def digests(sets: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of every set."""
    out = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(sets ^ np.uint64(salt)))])
        out.append(mixed(sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return out[0], out[1]
