"""Words of whole Arrow batches as 64-bit hashes, with NumPy on the UTF-8 bytes.

A word's hash is a polynomial in its bytes, modulo 2**64, over a table of random numbers per
byte, mixed at the end. Prefix sums give all words of a batch at once: the cost is a few
operations per byte, whatever the words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, and 5 modulo 8
INVERSE = np.uint64(pow(int(FACTOR), -1, 1 << 64))
#: Bytes of text that are hashed at once; a longer text is a slice of its own.
SLICE_BYTES = 1_000_000

SPACES = bytes([9, 10, 11, 12, 13, 32])
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_table(is_word, lower: bool) -> np.ndarray:
    """Random numbers by byte, 0 where the byte separates words."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    if lower:
        values = values[np.frombuffer(LOWER, np.uint8)]
    return np.where([is_word(b) for b in range(256)], values, np.uint64(0))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of all words of texts: ``hashes``, and ``starts`` of each text in them."""

    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, table: np.ndarray):
        self.table = table

    def _scale(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers) < size:
            longest = max(size, SLICE_BYTES + (1 << 18))
            for name, factor in (("_powers", FACTOR), ("_inverse", INVERSE)):
                steps = np.full(longest, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self._powers[:size], self._inverse

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        values = self.table[raw]
        inside = values != 0
        # A word also ends where its text does.
        edge = np.zeros(len(raw) + 1, bool)
        edge[offsets] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        powers, inverse = self._scale(len(raw) + 1)
        np.multiply(values, powers[:-1], out=values)
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values, out=sums[1:])
        hashes = mixed((sums[end] - sums[begin]) * inverse[begin])
        return hashes, np.searchsorted(begin, offsets).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of text, or one row."""
    for batch in batches:
        texts = batch.column(column)
        sizes = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit)))
            yield batch.slice(at, upto - at)
            at = upto


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbours, over the borders of texts too."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= FACTOR
        out += hashes[k: k + n]
    return mixed(out)


def within(starts: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` words follow in the same text."""
    total = int(starts[-1])
    ends = np.repeat(starts[1:], np.diff(starts))
    return np.flatnonzero(np.arange(total) + size <= ends)
