"""Words and word shingles as 64-bit hashes, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Recent(dict):
    """Remembers what a function gave for its latest keys, at most twice ``LIMIT`` of them.

    When full, all entries become the old generation; those asked for again move
    back, the rest go at the next turn. So memory is bounded and common keys stay.
    """

    LIMIT = 300_000

    def __init__(self, compute, limit: int | None = None):
        self.compute, self.old = compute, {}
        if limit:
            self.LIMIT = limit

    def forget(self) -> None:
        self.clear()
        self.old = {}

    def has(self, key) -> bool:
        return key in self or key in self.old

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.LIMIT:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


#: Bytes of text that are hashed together, and the longest word that is hashed so.
BLOCK, LONGEST = 1 << 17, 256
_SPACE = b" \t\n\x0b\x0c\r"
_SOLID = np.array([b not in _SPACE for b in range(256)])
#: A random value for each byte, equal for a letter and its capital.
_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15
_POWER = np.cumprod(np.full(2 * BLOCK, _BASE, dtype=np.uint64))
_BACK = np.cumprod(np.full(2 * BLOCK, pow(_BASE, -1, 2**64), dtype=np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base of running sums, and those of its inverse."""
    if n <= len(_POWER):
        return _POWER[:n], _BACK[:n]
    return np.cumprod(np.full(n, _BASE, dtype=np.uint64)), np.cumprod(np.full(n, pow(_BASE, -1, 2**64), dtype=np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, A-Z lower-cased, split at space and \\t to \\r.

    A word's hash is a polynomial in its bytes, found for all words of a block at
    once from running sums. Words too long for that are hashed one by one.
    """
    if len(text) <= BLOCK:
        return _block(text)[0]
    parts, at = [], 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):  # to the end of a word
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                ends = [i for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (i := text.find(c, end)) >= 0]
                cut = min(ends, default=len(text) - 1)
            end = cut + 1
        parts.append(_block(text[at:end])[0])
        at = end
    return np.concatenate(parts)


def together(rows: Iterable[tuple], size: int = BLOCK) -> Iterator[tuple[list, list[bytes]]]:
    """Rows (id, text) as lists of ids and of texts that have ``size`` bytes at most, or are one longer text."""
    ids: list = []
    found: list[bytes] = []
    filled = 0
    for row_id, text in rows:
        if found and filled + len(text) >= size:
            yield ids, found
            ids, found, filled = [], [], 0
        ids.append(row_id)
        found.append(text)
        filled += len(text) + 1
    if found:
        yield ids, found


def words_together(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of some texts, one text after the other, and the number of words of each."""
    joined = b"\n".join(found)
    if len(joined) > BLOCK:
        parts = [word_hashes(text) for text in found]
        return np.concatenate(parts), np.array([len(p) for p in parts])
    hashes, start = _block(joined)
    ends = np.cumsum([len(text) + 1 for text in found])
    return hashes, np.diff(np.searchsorted(start, ends), prepend=0)


def _block(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words, and where they begin."""
    codes = np.frombuffer(text, dtype=np.uint8)
    solid = np.zeros(len(codes) + 2, dtype=np.int8)
    solid[1:-1] = _SOLID[codes]
    edge = np.diff(solid)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = end - start
    long = size > LONGEST
    if len(codes) > len(_POWER):
        long[:] = True
        out = np.empty(len(start), dtype=np.uint64)
    else:
        with np.errstate(over="ignore"):
            total = np.zeros(len(codes) + 1, dtype=np.uint64)
            np.cumsum(_VALUE[codes] * _POWER[: len(codes)], out=total[1:])
            out = mix((total[end] - total[start]) * _BACK[start] + size.astype(np.uint64))
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh3_64_intdigest(text[start[i] : end[i]].lower())
    return out, start


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(31))


#: An odd factor for each place of a shingle.
_PLACE = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Hash of each run of n words in order; of the whole sequence where it is shorter; none without words."""
    k = min(n, len(words))
    if k == 0:
        return words
    count = len(words) - k + 1
    with np.errstate(over="ignore"):
        out = np.full(count, np.uint64(k))
        for i in range(k):
            out += words[i : i + count] * _PLACE[i]
    return mix(out)


def spark_hash(values: np.ndarray) -> np.ndarray:
    """What Spark's xxhash64 gives for long values, so that tasks can look them up in a bitmap."""
    with np.errstate(over="ignore"):
        h = np.uint64(42 + 8) + _P5
        x = values.astype(np.int64).view(np.uint64) * _P2
        x = ((x << np.uint64(31)) | (x >> np.uint64(33))) * _P1
        h = h ^ x
        h = ((h << np.uint64(27)) | (h >> np.uint64(37))) * _P1 + _P4
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


# Fixed values of the published 64-bit xxHash.
_P1, _P2, _P3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_P4, _P5 = np.uint64(0x85EBCA77C2B2AE63), np.uint64(0x27D4EB2F165667C5)
