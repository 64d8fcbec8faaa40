"""Elias-Fano sequences: sorted numbers in little space, searched without unpacking, with NumPy.

A number's low bytes are stored as they are. Its high part is a count of zeros in a bit vector
that has a one for every number, so the numbers with one high part lie between two zeros.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD, HEAD_SIZE = "<qqqq", 32
ONE = np.uint64(1)


class EliasFano:
    """A sequence in one block of bytes: a header, the bit vector, its zero counts, the low bytes."""

    def __init__(self, block, at: int = 0):
        self.n, self.low_bytes, words, self.size = struct.unpack_from(HEAD, block, at)
        at += HEAD_SIZE
        self.bits = np.frombuffer(block, "<u8", words, at)
        at += 8 * words
        self.zeros = np.frombuffer(block, "<u4", words + 1, at)  # before each word of the bit vector
        at += 4 * (words + 1)
        self.low = np.frombuffer(block, np.uint8, self.n * self.low_bytes, at).reshape(self.n, self.low_bytes)

    @staticmethod
    def encode(values: np.ndarray, limit: int) -> bytes:
        """Bytes of ascending unsigned ``values`` below ``limit``."""
        n = len(values)
        spare = max(0, (limit // max(1, n) - 1).bit_length())
        low_bytes = min(8, -(-spare // 8))
        low = values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :low_bytes]
        high = values >> np.uint64(8 * low_bytes) if low_bytes < 8 else np.zeros(n, np.uint64)
        buckets = ((limit - 1) >> 8 * low_bytes) + 1 if limit else 1
        words = (n + buckets) // 64 + 1
        vector = np.zeros(words * 64, np.uint8)
        vector[high.astype(np.int64) + np.arange(n)] = 1
        packed = np.packbits(vector, bitorder="little")
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(packed.view("<u8")).astype(np.int64)))).astype("<u4")
        body = b"".join((packed.tobytes(), zeros.tobytes(), np.ascontiguousarray(low).tobytes()))
        return struct.pack(HEAD, n, low_bytes, words, HEAD_SIZE + len(body)) + body

    def _wide(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 8), np.uint8)
        out[:, : self.low_bytes] = rows
        return out.view("<u8")[:, 0]

    def values(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(self.bits.view(np.uint8), bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64)
        return (high << np.uint64(8 * self.low_bytes) if self.low_bytes < 8 else np.zeros(self.n, np.uint64)) | self._wide(self.low)

    def _zero(self, number: np.ndarray) -> np.ndarray:
        """Position of the zero with each number, from 0."""
        word = np.searchsorted(self.zeros, number.astype(self.zeros.dtype), "right") - 1
        left = number - self.zeros[word].astype(np.int64)
        rest, at = ~self.bits[word], np.zeros(len(number), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the part of the word the zero is in
            count = np.bitwise_count(rest & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = left >= count
            left -= np.where(skip, count, 0)
            at += np.where(skip, width, 0)
            rest = np.where(skip, rest >> np.uint64(width), rest)
        return 64 * word + at

    def bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and one past the last index of the numbers with each high part."""
        start = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - high + 1, 0)
        return start, self._zero(high) - high

    def successor(self, wanted: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of the first number that is not below each wanted one, inside its bucket.

        Past the bucket's last number the index is that of the next bucket's first. With ``first``
        and ``last``, only indices from the one to before the other are searched for each.
        """
        if self.low_bytes == 8:
            low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), self.n, np.int64)
            rest = wanted
        else:
            low, high = self.bucket((wanted >> np.uint64(8 * self.low_bytes)).astype(np.int64))
            rest = wanted & np.uint64((1 << 8 * self.low_bytes) - 1)
        if first is not None:
            low, high = np.maximum(low, first), np.minimum(high, last)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            below = self._wide(self.low[middle]) < rest[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        return low

    def find(self, wanted: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Index of each wanted number, or -1, among all or from ``first`` to before ``last``. Wanted numbers are below the limit."""
        if not self.n:
            return np.full(len(wanted), -1, np.int64)
        at = self.successor(wanted, first, last)
        near = np.minimum(at, self.n - 1)
        # The index lies in the wanted bucket or is past it; then the low bytes may still agree.
        if self.low_bytes < 8:
            start, end = self.bucket((wanted >> np.uint64(8 * self.low_bytes)).astype(np.int64))
            inside = (start <= at) & (at < end)
            rest = wanted & np.uint64((1 << 8 * self.low_bytes) - 1)
        else:
            inside, rest = at < self.n, wanted
        if first is not None:
            inside &= (first <= at) & (at < last)
        return np.where(inside & (self._wide(self.low[near]) == rest), at, -1)

    def access(self, index: np.ndarray) -> np.ndarray:
        """The numbers at some indices."""
        ones_before = 64 * np.arange(len(self.zeros), dtype=np.int64) - self.zeros.astype(np.int64)
        word = np.searchsorted(ones_before, index, "right") - 1
        left = index - ones_before[word]
        rest, at = self.bits[word], np.zeros(len(index), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(rest & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = left >= count
            left -= np.where(skip, count, 0)
            at += np.where(skip, width, 0)
            rest = np.where(skip, rest >> np.uint64(width), rest)
        high = (64 * word + at - index).astype(np.uint64)
        return (high << np.uint64(8 * self.low_bytes) if self.low_bytes < 8 else np.zeros(len(index), np.uint64)) | self._wide(self.low[index])
