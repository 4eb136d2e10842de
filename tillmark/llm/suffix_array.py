"""Suffix arrays by two-stage sorting, and common prefixes of neighbours."""

from __future__ import annotations

import numpy as np

#: Bytes that directly sorted suffixes are compared by; order beyond them is left open.
DEPTH = 64


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, with zeros behind the end."""
    padded = np.concatenate([text, np.zeros(DEPTH + 8, np.uint8)])
    value = np.zeros(len(text) + DEPTH, np.uint64)
    for k in range(8):
        value = (value << np.uint64(8)) | padded[k : k + len(value)]
    return value


def _rising(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor; the last one is larger than the empty one."""
    starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
    following = np.append(text[starts[1:]].astype(np.int16), -1)
    return np.repeat(following > text[starts], np.diff(np.append(starts, len(text))))


def _sort_directly(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in order of the ``DEPTH`` bytes that follow, eight at a time among those still equal."""
    order = places[np.argsort(words[places], kind="stable")]
    key = words[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])[: len(order)]
    for depth in range(8, DEPTH, 8):
        # Members of groups of equals: those that don't begin one, and those that are followed by such.
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not len(tied):
            break
        group = np.cumsum(fresh)[tied]
        key = words[order[tied] + depth]
        within = np.lexsort((key, group))
        order[tied] = order[tied][within]
        key = key[within]
        fresh[tied[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the suffixes of ``text`` (bytes) in order, as far as their first ``DEPTH`` bytes tell.

    Only suffixes smaller than their successor are sorted directly. A larger one stands in the bucket of its first
    byte in order of its successor, so scanning the buckets in order puts each of them where it belongs.
    """
    if not len(text):
        return np.zeros(0, np.int64)
    rising = _rising(text)
    direct = _sort_directly(np.flatnonzero(rising), _words(text))
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[text[-1]].append(np.array([len(text) - 1]))
    buckets = []
    for byte in range(256):
        induced = []
        found = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(found):
            induced.append(found)
            # A run of one byte induces itself within its bucket.
            before = found[found > 0] - 1
            found = before[(text[before] == byte) & ~rising[before]]
        bucket = np.concatenate([*induced, direct[bounds[byte] : bounds[byte + 1]]])
        buckets.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~rising[before] & (text[before] > byte)]
        if len(before):
            first = text[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            at = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            for start, end in zip(at, [*at[1:], len(before)], strict=True):
                waiting[first[start]].append(before[start:end])
    return np.concatenate(buckets).astype(np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` and the one before it, counted up to ``most`` bytes."""
    words = _words(text)
    lengths = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for depth in range(0, most, 8):
        different = words[order[open_] + depth] ^ words[order[open_ - 1] + depth]
        same = different == 0
        # Leading zero bytes of the difference.
        count = np.zeros(len(open_), np.int64)
        for k in range(8):
            count += different < (np.uint64(1) << np.uint64(56 - 8 * k))
        lengths[open_] = depth + np.where(same, 8, count)
        open_ = open_[same]
    return np.minimum(lengths, most)
