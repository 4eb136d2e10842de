"""Terms of texts: runs of bytes between separators, with A-Z in lower case, packed into 64-bit words.

A term of up to 8 bytes makes one word and one of up to 16 bytes two, first byte highest and zeros behind the last.
Terms hold no zero byte, so equal words mean equal terms. Longer terms are told apart by their bytes, length by length.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from tillmark.llm import textbytes

#: Bytes of a term that one and two words hold.
ONE_WORD, TWO_WORDS = 8, 16

#: Terms of more bytes are copied one by one, others byte by byte.
SLICED = 64

_PADDING = np.zeros(TWO_WORDS, np.uint8)

#: What remains of a word of which so many bytes belong to the term.
_KEPT = np.array([0] + [(0xFFFFFFFFFFFFFFFF << (64 - 8 * n)) & 0xFFFFFFFFFFFFFFFF for n in range(1, 9)], np.uint64)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes separate terms, from first and last byte of each range; bytes above 0x7F never do."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


class Terms:
    """The terms of a run of documents: ``start`` and ``length`` of each in ``data``, ``first`` term of each document."""

    def __init__(self, data: np.ndarray, first: np.ndarray, separator: np.ndarray) -> None:
        self.data = np.concatenate([textbytes.LOWER[data], _PADDING])
        self.start, end, self.first = textbytes.runs(separator[data], first)
        self.length = end - self.start
        self._words = np.ndarray((len(self.data) - 7,), ">u8", self.data, strides=(1,))

    @property
    def document(self) -> np.ndarray:
        """The document of each term."""
        return textbytes.owner(self.first)

    def word(self, which: np.ndarray, at: int) -> np.ndarray:
        """Bytes ``at`` to ``at + 8`` of some terms as one word."""
        kept = np.clip(self.length[which] - at, 0, 8)
        return self._words[self.start[which] + at].astype(np.uint64) & _KEPT[kept]

    def words(self, which: np.ndarray) -> list[np.ndarray]:
        """One word of each of some terms, or two if any has more than 8 bytes."""
        n = 1 if not len(which) or self.length[which].max() <= ONE_WORD else 2
        return [self.word(which, 8 * k) for k in range(n)]

    def long_rows(self, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some long terms, all of one length at a time: which they are, and their bytes as values that sort as bytes."""
        order = which[np.argsort(self.length[which], kind="stable")]
        for some in np.split(order, np.flatnonzero(np.diff(self.length[order])) + 1):
            if not len(some):
                continue
            width = int(self.length[some[0]])
            rows = np.zeros(len(some), f"S{width}")
            cells = rows.view(np.uint8).reshape(len(some), width)
            if width > SLICED:
                for row, begin in zip(cells, self.start[some], strict=True):
                    row[:] = self.data[begin : begin + width]
            else:
                for k in range(width):
                    cells[:, k] = self.data[self.start[some] + k]
            yield some, rows


def of_texts(texts: pa.Array, separator: np.ndarray) -> Iterator[tuple[int, Terms]]:
    """The terms of a column of texts (NULL: none), run of documents by run: the first document of each, its terms."""
    for at, _, data, first in textbytes.blocks(texts):
        yield at, Terms(data, first, separator)


def packed(terms: Iterable[bytes]) -> np.ndarray:
    """Terms of up to 16 bytes as rows of two words."""
    spelled = np.array([term.ljust(TWO_WORDS, b"\0") for term in terms], f"S{TWO_WORDS}")
    # Trailing zeros are dropped from such values when taken out, not from their memory.
    return np.frombuffer(spelled.tobytes(), ">u8").reshape(-1, 2).astype(np.uint64)


def spelled_out(words: list[np.ndarray]) -> pa.Array:
    """The terms that words (one or two arrays of them) stand for."""
    rows = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    inside = rows != 0
    offsets = np.concatenate([[0], np.cumsum(inside.sum(axis=1))]).astype(np.int64)
    content = pa.py_buffer(np.ascontiguousarray(rows[inside]))
    return pa.Array.from_buffers(pa.large_string(), len(rows), [None, pa.py_buffer(offsets), content])


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """The order of rows by unsigned keys, the first counting most, equal rows as they were.

    One pass per 16 bits from the lowest on (numpy sorts 16-bit values by radix); digits that are all equal are
    skipped.
    """
    order = np.arange(len(keys[0]))
    for key in reversed(keys):
        for shift in range(0, 8 * key.itemsize, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def run_starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where a run of equal rows begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    change = np.ones(len(keys[0]), bool)
    change[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    return np.flatnonzero(change)
