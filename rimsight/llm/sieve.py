"""Bit sieves of bounded size: what may be in a set, broadcast to tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 32768  # bits of one bitmap of the built-in bitmap functions


def bits_for(n: int, most: int, least: int = 1 << 16) -> int:
    """Bits, a power of two, for n members at about one in 32, within the bounds."""
    return max(least, min(most, 1 << max(1, (32 * n - 1).bit_length())))


def sieve_of(rows: DataFrame, slot: Column, bits: int) -> bytes:
    """Bitmap of the slots (0 to bits - 1) of all rows: bits / 8 bytes, whatever the rows."""
    at = slot + 1
    parts = rows.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("part"))
    out = np.zeros(max(bits // 8, _BLOCK // 8), np.uint8)
    for r in parts.toLocalIterator():
        first = (r["bucket"] - 1) * (_BLOCK // 8)
        out[first : first + _BLOCK // 8] = np.frombuffer(r["part"], np.uint8)
    return out.tobytes()


def passes(sieve: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (sieve[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
