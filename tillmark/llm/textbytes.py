"""Texts of a batch as one array of UTF-8 bytes: words, lines and hashes of stretches, for many documents at once."""

from __future__ import annotations

import functools
import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer document is worked on alone.
BLOCK_BYTES = 1 << 22

_SEED = 0x9E3779B97F4A7C15

#: What remains of a word of which so many bytes belong to a stretch.
_KEPT = np.array([0] + [(0xFFFFFFFFFFFFFFFF << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(1, 9)], np.uint64)

#: The white space that separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    factor = np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * factor
    values = (values ^ (values >> np.uint64(32))) * factor
    return values ^ (values >> np.uint64(32))


#: Bytes of a stretch that are hashed as two 64-bit words.
_PACKED = 16


class Hasher:
    """64-bit hashes of stretches of a byte array, whatever their length.

    Stretches of up to 16 bytes, as nearly all words are, are hashed as two words and their length, all at a time;
    longer ones by BLAKE2b, one by one. Unlike sums of powers neither is deceived by texts of a regular structure.
    """

    def __init__(self, data: np.ndarray) -> None:
        self._data = np.concatenate([data, np.zeros(_PACKED, np.uint8)])
        self._words = np.ndarray((len(self._data) - 7,), ">u8", self._data, strides=(1,))

    def _word(self, start: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
        return self._words[np.minimum(start + at, len(self._words) - 1)].astype(np.uint64) & _KEPT[np.clip(length - at, 0, 8)]

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = end - start
        mixed = mix(self._word(start, length, 0) ^ np.uint64(_SEED)) + length.astype(np.uint64)
        mixed = mix(mix(mixed) ^ self._word(start, length, 8))
        text = self._data.tobytes() if (length > _PACKED).any() else b""
        for k in np.flatnonzero(length > _PACKED).tolist():
            digest = hashlib.blake2b(text[start[k] : end[k]], digest_size=8).digest()
            mixed[k] = int.from_bytes(digest, "little")
        return mixed


class _Powers:
    """Powers of the base of the hash and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            # Twice as many each time, so that they are made anew rarely and never take much more than is hashed.
            n = max(n, 2 * len(self.up))
            inverse = pow(_SEED, -1, 1 << 64)
            for name, base in (("up", _SEED), ("down", inverse)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = _Powers()


class StretchHasher:
    """64-bit hashes of stretches of a byte array, whatever their length, in constant time each.

    They are sums of powers, which long texts of a regular structure (from about a thousand bytes on) can deceive: only
    for shorter stretches, or where the bytes are compared as well.
    """

    def __init__(self, data: np.ndarray) -> None:
        _POWERS.upto(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWERS.up[: len(data)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * _POWERS.down[start])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and where each begins; NULL counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8)[first[0] : first[-1]] if data is not None else np.zeros(0, np.uint8)
    return content, first - first[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents of at most ``size`` bytes: first, last + 1, their bytes and where each begins."""
    data, first = utf8(column)
    at, n = 0, len(first) - 1
    while at < n:
        end = max(at + 1, int(np.searchsorted(first, first[at] + size, "right")) - 1)
        yield at, end, data[first[at] : first[end]], first[at : end + 1] - first[at]
        at = end


def words(
    data: np.ndarray, first: np.ndarray, separator: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of the first word of each document (one more at the end)."""
    return runs(separator[data], first)


def runs(
    outside: np.ndarray, first: np.ndarray, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``words``, from whether each byte lies outside of words and places before which words end besides."""
    inside = np.zeros(len(outside) + 2, bool)
    inside[1:-1] = ~outside
    border = np.zeros(len(outside) + 1, bool)
    border[first] = True
    if cuts is not None:
        border[cuts] = True
    before, after = inside[:-1], inside[1:]
    start = np.flatnonzero(after & (~before | border))
    end = np.flatnonzero(before & (~after | border))
    return start, end, np.searchsorted(start, first)


@functools.cache
def categories() -> np.ndarray:
    """The first letter of the Unicode category of each code point, as a byte."""
    return np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode(), np.uint8)


def code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """The code points that begin at some places of UTF-8 bytes."""
    byte = data[lead].astype(np.int64)
    follow = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
    two = (byte & 0x1F) << 6 | follow[0]
    three = (byte & 0x0F) << 12 | follow[0] << 6 | follow[1]
    four = (byte & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2]
    points = np.select([byte < 0x80, byte < 0xE0, byte < 0xF0], [byte, two, three], four)
    return np.minimum(points, 0x10FFFF)


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes; those that reach into the next document must be left out by the caller."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    joined = hashes[:n].copy()
    for k in range(1, width):
        joined = mix(joined) + hashes[k : n + k]
    return mix(joined)


def owner(first: np.ndarray) -> np.ndarray:
    """The document of each element, from where each document begins."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums over stretches, which may be empty."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


class Distinct:
    """The distinct words of a block, spelled out between boundary marks, for features of their characters."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> None:
        self.hashes, where, self.inverse = np.unique(hashes, return_index=True, return_inverse=True)
        lengths = end[where] - start[where] + 2
        self.first = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(self.first[-1]) - np.repeat(self.first[:-1], lengths)
        source = np.repeat(start[where] - 1, lengths) + place
        marks = (place == 0) | (place == np.repeat(lengths, lengths) - 1)
        spelled = data[np.clip(source, 0, len(data) - 1)] if len(data) else np.zeros(0, np.uint8)
        self.spelled = np.where(marks, np.uint8(0), spelled)
        self._word = owner(self.first)

    def grams(self, width: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of each run of ``width`` bytes within a word and its marks, and the word it belongs to."""
        n = len(self.spelled) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        value = np.full(n, width, np.uint64)
        for k in range(width):
            value = (value << np.uint64(8)) | self.spelled[k : n + k].astype(np.uint64)
        within = self._word[:n] == self._word[width - 1 :]
        return (mix(value[within]) % np.uint64(buckets)).astype(np.int64), self._word[:n][within]
