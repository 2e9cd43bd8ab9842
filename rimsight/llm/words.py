"""Vectorised words, word hashes and n-gram hashes of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_STEP = U64(0xD6E8FEB86659FD93)
CHUNK = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(separators: bytes) -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    out[list(separators)] = 0
    return out


# Byte tables: A-Z lower case, separators 0, bytes outside ASCII as they are.
BLANK_SPLIT = _table(bytes([32, 9, 10, 11, 12, 13]))
PLAIN_SPLIT = _table(bytes(c for c in range(128) if not chr(c).isalnum()))
# NUL is a word byte where only blanks split; 65 is free since A is lower case
BLANK_SPLIT[0] = 65


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes over all bits."""
    h = h ^ (h >> U64(32))
    h = h * _STEP
    h = h ^ (h >> U64(29))
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK, 1 << max(n - 1, 1).bit_length())
    if size not in _POWERS:
        if len(_POWERS) > 1:  # one long text must not stay in memory for good
            _POWERS.clear()
        made = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        _POWERS[size] = (made[0], made[1])
    return _POWERS[size]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column, one text after the other, and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(bytes_: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about CHUNK bytes that end between words or texts."""
    at, n = 0, len(bytes_)
    while at < n:
        end = min(at + CHUNK, n)
        if end < n:
            near = offsets[np.searchsorted(offsets, end, "right") - 1]
            if near > at:
                end = int(near)
            else:
                gaps = np.flatnonzero(bytes_[at:end] == 0)
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:  # a word longer than a piece
                    after = np.flatnonzero(bytes_[end:] == 0)
                    stop = end + int(after[0]) if len(after) else n
                    end = min(stop, int(offsets[np.searchsorted(offsets, end, "left")]))
        yield at, end
        at = end


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash of every word, the n + 1 word offsets of the texts, and hashes of word prefixes.

    A prefix hash covers the first p bytes, or the whole word where it is shorter.
    """
    found, places, heads = [], [], [[] for _ in prefixes]
    bytes_ = table[data]
    for at, end in _cuts(bytes_, offsets):
        part = bytes_[at:end]
        inside = part != 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        marks = offsets[np.searchsorted(offsets, at, "left") : np.searchsorted(offsets, end, "left")] - at
        first[marks] = inside[marks]
        starts = np.flatnonzero(first)
        if not len(starts):
            continue
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        before = marks[marks > 0] - 1
        last[before] = inside[before]
        ends = np.flatnonzero(last) + 1
        power, inverse = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[: len(part)], out=sums[1:])
        back = inverse[starts]
        size = ends - starts
        found.append(mix((sums[ends] - sums[starts]) * back + size.astype(np.uint64)))
        places.append(starts + at)
        for k, p in enumerate(prefixes):
            to = np.minimum(starts + p, ends)
            heads[k].append(mix((sums[to] - sums[starts]) * back + U64(1000 + p)))
    if not found:
        none = np.zeros(0, np.uint64)
        return none, np.zeros(len(offsets), np.int64), [none for _ in prefixes]
    starts = np.concatenate(places)
    return np.concatenate(found), np.searchsorted(starts, offsets, "left"), [np.concatenate(h) for h in heads]


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; the last k - 1 places of a text mean nothing."""
    n = len(hashes)
    out = hashes.copy()
    for j in range(1, min(k, n)):
        out *= _STEP
        out[: n - j] += hashes[j:]
    return mix(out)


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments of these lengths: the segment of each element and its place in it."""
    owner = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - start[owner]
