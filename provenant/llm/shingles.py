"""Words and word shingles of texts as arrays of 64-bit hashes, for many texts at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0x9E3779B97F4A7C15)
_blank = np.zeros(256, bool)
_blank[[0x20, *range(0x09, 0x0E)]] = True
_codes = np.random.default_rng(64).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A-Z count as a-z, nothing else is changed.
_lower_codes = _codes.copy()
_lower_codes[ord("A") : ord("Z") + 1] = _codes[ord("a") : ord("z") + 1]
_base = 0x9E3779B97F4A7C15
#: Bytes hashed at a time, so that their arrays stay in a core's cache.
CHUNK = 1 << 16


class WordHashes(dict):
    """64-bit hashes of words, remembered; the table is emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode())
        return h


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else changed."""
    return text.translate(LOWER) if not text.isascii() else text.lower()


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of an odd base and of its inverse, as many as asked for: a range's polynomial from two prefix sums."""

    def __init__(self) -> None:
        self.up, self.down = powers(_base, 2), powers(pow(_base, -1, 1 << 64), 2)

    def ranges(self, terms: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sum of ``terms[i] * base ** (start - i)`` over each range: it depends on the terms, not on their place."""
        n = len(terms) + 1
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            self.up, self.down = powers(_base, size), powers(pow(_base, -1, 1 << 64), size)
        sums = np.zeros(n, np.uint64)
        np.cumsum(terms * self.down[: n - 1], out=sums[1:], dtype=np.uint64)
        return (sums[ends] - sums[starts]) * self.up[starts]


_powers = Powers()


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of texts that lie end to end: hashes, first bytes, ends, and each text's first word.

    A separator is a byte of its own in UTF-8, so the bytes are searched and nothing is decoded.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = True):
        inside, n = ~_blank[data], len(data)
        border, before, after = np.zeros(n + 1, bool), np.zeros(n, bool), np.zeros(n, bool)
        border[offsets] = True
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.starts = np.flatnonzero(inside & (~before | border[:-1]))
        self.ends = np.flatnonzero(inside & (~after | border[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        codes, parts, at = _lower_codes if lower else _codes, [], 0
        while at < len(self.starts):
            end = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + CHUNK, "right")))
            lo, hi = self.starts[at], self.ends[end - 1]
            parts.append(_powers.ranges(codes[data[lo:hi]], self.starts[at:end] - lo, self.ends[at:end] - lo))
            at = end
        raw = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.hashes = mixed(raw + (self.ends - self.starts).astype(np.uint64) * MIX)

    def of(self, row: int) -> np.ndarray:
        return self.hashes[self.first[row] : self.first[row + 1]]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow column of texts, end to end, and where each begins; a null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each word on."""
    n = max(0, len(words) - size + 1)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = mixed(h * MIX + words[k : n + k])
    return h


def shingle_sets(texts: pa.Array, size: int, part_bytes: int = 1 << 20) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words; fewer words make one shingle, none make none."""
    data, offsets = text_bytes(texts)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + part_bytes, "right")) - 1)
        words = Words(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
        every = runs(words.hashes, size)
        for row in range(end - start):
            a, n = int(words.first[row]), int(words.first[row + 1] - words.first[row])
            yield np.unique(every[a : a + n - size + 1] if n >= size else runs(words.of(row), n)[: min(n, 1)])
        start = end


def shingle_set(text: str, size: int = 2) -> np.ndarray:
    """The set of one text."""
    return next(shingle_sets(pa.array([text], pa.large_string()), size))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int = 80) -> bool:
    both = common(a, b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)
