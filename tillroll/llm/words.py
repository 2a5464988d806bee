"""Words of UTF-8 texts as arrays: 64-bit hashes, places and lengths.

Separators are ASCII bytes, so texts are cut at byte level. A text is read in
parts of about a megabyte that end at a separator; what a word hashes to does
not depend on the part it is read in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np

LONG = 4096  # bytes from which a word is hashed by a digest
PART = 1 << 20
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chained(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of all but its last word."""
    return mix(prefix * _GOLD + word)


def powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_POWERS = powers(_STEP, LONG)


def _digest(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little") or 1


class Separators:
    """Which bytes end a word."""

    def __init__(self, signs: bytes):
        self.table = np.zeros(256, bool)
        self.table[list(signs)] = True
        self.find = re.compile(b"[" + re.escape(signs) + b"]").search

    def parts(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Offset and bytes of parts that end at a separator."""
        at = 0
        while len(text) - at > 2 * PART:
            found = self.find(text, at + PART)
            if not found:
                break
            yield at, text[at:found.start()]
            at = found.start()
        yield at, text[at:]

    def words(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hashes (never 0), offsets and lengths of the words, part by part."""
        for at, part in self.parts(text):
            if len(part) > 4 * PART:  # one huge word and little else: no arrays of its bytes
                found = [(at + m.start(), m.group()) for m in re.finditer(
                    b"[^" + re.escape(bytes(np.flatnonzero(self.table).tolist())) + b"]+", part)]
                yield (np.array([self.hash_of(w) for _, w in found], np.uint64),
                       np.array([b for b, _ in found], np.int64), np.array([len(w) for _, w in found], np.int64))
                continue
            signs = np.frombuffer(part, np.uint8)
            inside = ~self.table[signs]
            edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
            begins, ends = edge[::2], edge[1::2]
            if not len(begins):
                continue
            sizes = ends - begins
            own = signs[inside]
            firsts = np.cumsum(sizes) - sizes
            place = np.arange(len(own)) - np.repeat(firsts, sizes)
            values = _BYTES[own] * _POWERS[np.minimum(place, LONG - 1)]
            hashes = mix(np.add.reduceat(values, firsts))
            hashes[hashes == 0] = 1
            for i in np.flatnonzero(sizes >= LONG):
                hashes[i] = _digest(part[begins[i]:ends[i]])
            yield hashes, begins + at, sizes

    def hash_of(self, word: bytes) -> int:
        if len(word) >= LONG:
            return _digest(word)
        signs = np.frombuffer(word, np.uint8)
        return int(mix((_BYTES[signs] * _POWERS[:len(signs)]).sum(keepdims=True, dtype=np.uint64))[0]) or 1


WHITE = Separators(b" \t\n\x0b\x0c\r")


def joined(found: Iterator[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts' arrays as one."""
    parts = list(found)
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(p) for p in zip(*parts))
