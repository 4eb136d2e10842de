"""Benchmark decontamination by greedy string tiling.

Runs of tokens that a document shares with a benchmark item (seeds) say which pairs to compare. Of each pair the longest
common run that overlaps none taken before is taken as a tile, again and again, until none of the least length is left;
runs are found by Karp-Rabin hashes of ever shorter windows. As tiles may lie in any order, passages whose sentences
were moved are caught too. A pair is reported if the tiles cover enough of the item.
"""

from __future__ import annotations

import functools
import warnings
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import textbytes
from tillmark.llm.rows import releasing

#: Tokens of the shortest tile; also the length of a seed.
LEAST_TILE = 5

#: Share of an item's tokens that tiles must cover.
COVERAGE = 0.5

#: Bytes of benchmark text that one pass over the documents compares with; a larger benchmark takes several passes.
BENCHMARK_BYTES = 8 << 20

LEAKS = "doc_id long, item_id long, matched_tokens long, coverage double"

#: Tokens end at white space and at punctuation; these are the ASCII ones.
SEPARATOR = textbytes.SPACE.copy()
SEPARATOR[[byte for byte in range(0x21, 0x7F) if not chr(byte).isalnum()]] = True


#: First and last code point of blocks of scripts that are written without spaces between words.
UNSPACED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F),
    (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3038, 0x303B), (0x3040, 0x312F), (0x31A0, 0x31BF),
    (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9DF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18DFF), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)

_WITHIN, _BETWEEN, _ALONE = range(3)


@functools.cache
def _kinds() -> np.ndarray:
    """Whether each code point lies within a token, between tokens, or is a token of its own."""
    kinds = np.full(0x110000, _WITHIN, np.uint8)
    for low, high in UNSPACED:
        kinds[low : high + 1] = _ALONE
    kinds[np.isin(textbytes.categories(), np.frombuffer(b"PSZ", np.uint8))] = _BETWEEN
    # NEL and the spaces without width.
    kinds[[0x85, 0x200B, 0xFEFF]] = _BETWEEN
    return kinds


def tokens(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token (A-Z lower-cased), and the number of each document's first token.

    Tokens end at white space, punctuation and symbols; each code point of a script that is written without spaces is a
    token.
    """
    outside, cuts = SEPARATOR[data], None
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        kind = _kinds()[textbytes.code_points(data, lead)]
        length = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        between, alone = kind == _BETWEEN, kind == _ALONE
        for k in range(4):
            outside[lead[between & (length > k)] + k] = True
        cuts = np.concatenate([lead[alone], lead[alone] + length[alone]])
    start, end, first_token = textbytes.runs(outside, first, cuts)
    return textbytes.Hasher(textbytes.LOWER[data])(start, end), first_token


def _window_hashes(sequence: list[int], length: int) -> list[int]:
    """Rolling hash of each window of ``length`` tokens."""
    base, modulus = 1_000_003, (1 << 61) - 1
    top = pow(base, length, modulus)
    hashes, value = [], 0
    for at, token in enumerate(sequence):
        value = value * base + token
        if at >= length:
            value -= sequence[at - length] * top
        value %= modulus
        if at >= length - 1:
            hashes.append(value)
    return hashes


def _longest_matches(
    pattern: list[int], text: list[int], in_pattern: list[bool], in_text: list[bool], length: int
) -> tuple[int, list[tuple[int, int]]]:
    """The longest common runs of unmarked tokens, if of at least ``length``: their length and where they begin.

    A run is followed only from its first token, and of all runs only the longest so far are held. So a text that repeats
    a few tokens takes memory in proportion to its length, however many pairs of places agree.
    """
    table = defaultdict(list)
    for t, value in enumerate(_window_hashes(text, length)):
        table[value].append(t)
    longest, found = length, []
    for p, value in enumerate(_window_hashes(pattern, length)):
        inner = p > 0 and not in_pattern[p - 1]
        for t in table.get(value, ()):
            if inner and t > 0 and not in_text[t - 1] and pattern[p - 1] == text[t - 1]:
                continue
            run = 0
            while (
                p + run < len(pattern)
                and t + run < len(text)
                and pattern[p + run] == text[t + run]
                and not in_pattern[p + run]
                and not in_text[t + run]
            ):
                run += 1
            if run > longest:
                longest, found = run, []
            if run == longest:
                found.append((p, t))
    return longest, found


def greedy_tiles(pattern: list[int], text: list[int], least: int = LEAST_TILE) -> list[tuple[int, int, int]]:
    """Tiles (place in pattern, place in text, length), longest first; among equals the first places win.

    Windows of the text are looked up by rolling hash and each match is followed token by token. The longest matches
    become tiles, their tokens are marked, and the search is repeated; when a window length finds no more, half of it
    is tried, down to ``least``.
    """
    in_pattern, in_text = [False] * len(pattern), [False] * len(text)
    tiles = []
    length = max(least, min(len(pattern), len(text)))
    while True:
        run, found = _longest_matches(pattern, text, in_pattern, in_text, length)
        for p, t in found:
            if not any(in_pattern[p : p + run]) and not any(in_text[t : t + run]):
                in_pattern[p : p + run] = in_text[t : t + run] = [True] * run
                tiles.append((p, t, run))
        if not found:
            if length == least:
                return tiles
            length = max(least, length // 2)


class Seeds:
    """The items of a block of the benchmark and the hashes of their runs of ``LEAST_TILE`` tokens."""

    def __init__(self, rows: list[tuple[int | None, str]]) -> None:
        self.ids = [item for item, _ in rows]
        data, first = textbytes.utf8(pa.array([text for _, text in rows], pa.string()))
        hashes, self.first = tokens(data, first)
        self.tokens = hashes
        runs = textbytes.shingles(hashes, LEAST_TILE)
        item = textbytes.owner(self.first)
        inside = item[: len(runs)] == item[LEAST_TILE - 1 :] if len(runs) else np.zeros(0, bool)
        place = np.flatnonzero(inside)
        order = np.argsort(runs[place], kind="stable")
        #: Seeds in order of hash; one that occurs at several places has a row for each.
        self.hashes, self.place = runs[place][order], place[order]
        self.item = item[self.place]
        self.known = np.unique(self.hashes)


def _compare(
    seeds: Seeds, hashes: np.ndarray, runs: np.ndarray, hits: np.ndarray, coverage: float
) -> Iterator[tuple[int, int, float]]:
    """Items that the document's tiles cover enough of; ``hits`` are the places of its seeds."""
    low, high = (np.searchsorted(seeds.hashes, runs[hits], side) for side in ("left", "right"))
    counts = high - low
    found = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    place, own = seeds.place[found], np.repeat(hits, counts)
    item = seeds.item[found]
    for i in np.unique(item):
        mine = item == i
        begin, end = int(seeds.first[i]), int(seeds.first[i + 1])
        covered = np.zeros(end - begin, bool)
        for k in range(LEAST_TILE):
            covered[place[mine] - begin + k] = True
        # No tile covers a token that no seed covers.
        if covered.sum() < coverage * (end - begin):
            continue
        pattern = seeds.tokens[begin:end].tolist()
        # All tiles lie where seeds do: runs of the document's tokens around them, kept apart by a mark of their own.
        text: list[int] = []
        reach = -1
        for at in np.unique(own[mine]).tolist():
            if at > reach:
                text.append(-1)
            text.extend(hashes[max(at, reach) : at + LEAST_TILE].tolist())
            reach = at + LEAST_TILE
        matched = sum(length for _, _, length in greedy_tiles(pattern, text))
        if matched >= coverage * (end - begin):
            yield int(i), matched, matched / (end - begin)


def _found(texts: pa.Array, seeds: Seeds, coverage: float) -> Iterator[tuple[int, int, int, float]]:
    """Row, item, matched tokens and coverage of each leak in a column of texts."""
    for at, _, data, first in textbytes.blocks(texts):
        hashes, first_token = tokens(data, first)
        runs = textbytes.shingles(hashes, LEAST_TILE)
        if not len(runs) or not len(seeds.known):
            continue
        document = textbytes.owner(first_token)
        known = seeds.known[np.minimum(np.searchsorted(seeds.known, runs), len(seeds.known) - 1)] == runs
        hits = np.flatnonzero(known & (document[: len(runs)] == document[LEAST_TILE - 1 :]))
        for some in np.split(hits, np.flatnonzero(np.diff(document[hits])) + 1):
            if len(some):
                for found in _compare(seeds, hashes, runs, some, coverage):
                    yield (at + int(document[some[0]]), *found)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``BENCHMARK_BYTES`` bytes."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-size // BENCHMARK_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    for n in range(passes):
        rows = [(row["item_id"], row["text"]) for row in items.where(part == n).collect()]
        left_out = sum(too_short([text for _, text in rows]))
        if left_out:
            warnings.warn(f"{left_out} benchmark items of fewer than {LEAST_TILE} tokens match nothing", stacklevel=3)
        yield rows


def too_short(texts: list[str | None]) -> list[bool]:
    """Whether each text has fewer than ``LEAST_TILE`` tokens, so that as a benchmark item it matches nothing."""
    _, first_token = tokens(*textbytes.utf8(pa.array(texts, pa.string())))
    return (np.diff(first_token) < LEAST_TILE).tolist()


def _leaks_of_block(docs: DataFrame, rows: list[tuple[int | None, str]], coverage: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(rows)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = Seeds(shared.value)
        for batch in batches:
            ids = batch.column("doc_id")
            found = [
                (ids[row].as_py(), seeds.ids[item], matched, share)
                for row, item, matched, share in _found(batch.column("text"), seeds, coverage)
            ]
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "matched_tokens", "coverage"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(run), LEAKS)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains: doc_id, item_id, matched_tokens, coverage.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Documents that contain no item don't appear. Items of
    fewer than ``LEAST_TILE`` tokens, NULL ones among them, name no passage and match nothing; a warning says how many
    there are besides NULL ones (``too_short`` tells which). A pair of rows is
    reported once for each such pair, so repeated rows of either table repeat it; ids may be NULL. Other columns are
    ignored; if either table is empty so is the result.

    The benchmark goes to the tasks in blocks of about ``BENCHMARK_BYTES`` bytes, one pass over the documents each, so
    what a task holds doesn't grow with it; the driver reads all blocks while it builds the plan.
    """
    return reduce(DataFrame.unionAll, [_leaks_of_block(docs, rows, coverage) for rows in _blocks(benchmark)])


def keep_clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that contain no item of the benchmark; see ``leaks``.

    No row is moved between tasks. Of a larger benchmark each block goes over what the one before it left.
    """
    for rows in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(shared.value)
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                kept[[row for row, *_ in _found(batch.column("text"), seeds, coverage)]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(releasing(run), docs.schema)
    return docs
