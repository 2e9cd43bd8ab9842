"""Elias-Fano coding of a non-decreasing sequence, with select."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 512  # a select sample for every so many values
_HEAD = struct.Struct("<QQBxxxxxxx")


class EliasFano:
    """n values up to a bound in about n * (2 + log2(bound / n)) bits.

    Low bits stand side by side; high parts are a bit string with a one for each value. Every
    SAMPLE-th one's place is kept as a 32-bit number, so ``select`` reads a short stretch.
    """

    def __init__(self, n: int, bound: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.bound, self.low, self.high, self.samples = n, bound, low, high, samples
        self.width = max(0, (bound // n).bit_length() - 1) if n else 0

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        bound = int(values[-1]) if n else 0
        made = cls(n, bound, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        if not n:
            return made
        w = np.uint64(made.width)
        tops = (values >> w).astype(np.int64) + np.arange(n)
        high = np.zeros(int(tops[-1]) + 1, np.uint8)
        high[tops] = 1
        if made.width:
            bits = (values[:, None] >> np.arange(made.width, dtype=np.uint64)) & np.uint64(1)
            made.low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        made.high = np.packbits(high, bitorder="little")
        made.samples = tops[::SAMPLE].astype(np.uint32)
        return made

    def _lows(self, first: int, count: int) -> np.ndarray:
        if not self.width:
            return np.zeros(count, np.uint64)
        at = first * self.width
        bits = np.unpackbits(self.low[at // 8 : (at + count * self.width + 7) // 8], bitorder="little")
        bits = bits[at % 8 : at % 8 + count * self.width].reshape(count, self.width).astype(np.uint64)
        return (bits << np.arange(self.width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = at // 8, at % 8
        while True:
            bits = np.unpackbits(self.high[byte : byte + 128], bitorder="little")
            bits[:skip] = 0
            ones = np.flatnonzero(bits)
            if left < len(ones):
                top = byte * 8 + int(ones[left]) - i
                return (top << self.width) | int(self._lows(i, 1)[0])
            left -= len(ones)
            byte, skip = byte + 128, 0

    def values(self, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` values from ``first`` on."""
        count = self.n - first if count is None else min(count, self.n - first)
        if count <= 0:
            return np.zeros(0, np.uint64)
        start = first - first % SAMPLE
        stop = (first + count + SAMPLE - 1) // SAMPLE
        begin = int(self.samples[start // SAMPLE])
        end = int(self.samples[stop]) if stop < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[begin // 8 : (end + 7) // 8], bitorder="little")
        bits[: begin % 8] = 0
        ones = np.flatnonzero(bits)[first - start : first - start + count] + begin // 8 * 8
        tops = (ones - np.arange(first, first + count)).astype(np.uint64)
        return (tops << np.uint64(self.width)) | self._lows(first, count)

    def to_bytes(self) -> bytes:
        return _HEAD.pack(self.n, self.bound, self.width) + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> EliasFano:
        n, bound, width = _HEAD.unpack_from(raw)
        low = (n * width + 7) // 8
        samples = (n + SAMPLE - 1) // SAMPLE * 4
        body = np.frombuffer(raw, np.uint8, offset=_HEAD.size)
        return cls(n, bound, body[:low], body[low : len(body) - samples], np.frombuffer(body[len(body) - samples :].tobytes(), "<u4"))
