"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text: str | None) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    words = BLANK.findall(low(text))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near(rows: list[tuple]) -> list[tuple]:
    """(id, shingles, component) of (id, text) rows; an id that repeats is one document."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    return sorted((i, len(s), find(i)) for i, s in sets)


def leaks(rows: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    grams: dict[tuple, set[str]] = {}
    for item, text in items:
        words = PLAIN.findall(low(text))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words and item is not None else 0):
            grams.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    out = []
    for doc, text in rows:
        words, hit, found = PLAIN.findall(low(text)), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(words) - size + 1):
                if (own := grams.get(tuple(words[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= own
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def repeats(rows: list[tuple], length: int = 100) -> dict:
    """id: (bytes, removed, spans, digest of what is kept); rows in corpus order."""
    seen: set[bytes] = set()
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if raw[s : s + length] in seen:
                gone[s : s + length] = b"\x01" * length
            else:
                seen.add(raw[s : s + length])
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def kept_lines(rows: list[tuple]) -> list[tuple]:
    def key(line):
        return low(line.strip(" \t\n\x0b\x0c\r"))

    holders: dict[str, set] = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out
