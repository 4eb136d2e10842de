"""Ranked lexical search, reversed: the index holds the items that are searched for, and documents stream through it.

The items' terms make an inverted index (term to items) that every task gets. A first pass over the documents counts
what the weights need: documents, terms, and documents per term of the index. In a second pass each document's term
counts go through the index, which adds up its score for every item at once, and each task keeps the best documents of
every item in a heap of bounded size. Heaps are merged in two steps.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm import terms as T
from tillmark.llm import textbytes
from tillmark.llm.rows import slices

#: Documents returned for each item.
TOP = 10

# The terms, as a pattern and as the ASCII bytes between them.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEPARATOR = T.separators((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))

#: Bytes of terms and postings that one index holds at most (one item at least); more items take more passes.
INDEX_BYTES = 8 << 20

#: Scores and postings worked on at a time.
CELLS = 1 << 21

#: Groups that the heaps of an item are merged in before they are merged to one.
MERGE_GROUPS = 64

MATCHES = "item_id long, doc_id long, score long"


class Index:
    """The distinct terms of some items, each with the items that hold it."""

    def __init__(self, pairs: list[tuple[int | None, str]]) -> None:
        """``pairs`` are distinct pairs of an item and a term."""
        numbers: dict[int | None, int] = {}
        holders: dict[bytes, list[int]] = {}
        for item, term in pairs:
            holders.setdefault(term.encode(), []).append(numbers.setdefault(item, len(numbers)))
        self.items = list(numbers)
        spelled = sorted(holders, key=lambda term: (len(term) > T.TWO_WORDS, len(term), term))
        #: Postings of term t: ``holder[first[t] : first[t + 1]]``.
        self.first = np.cumsum([0, *(len(holders[term]) for term in spelled)])
        self.holder = np.array([item for term in spelled for item in holders[term]], np.int64)
        short = [term for term in spelled if len(term) <= T.TWO_WORDS]
        words = T.packed(short)
        self._heads, head = np.unique(words[:, 0], return_inverse=True)
        self._tails, tail = np.unique(words[:, 1], return_inverse=True)
        codes = head * max(1, len(self._tails)) + tail
        self._short = np.argsort(codes)
        self._codes = codes[self._short]
        self._long: dict[int, tuple[np.ndarray, int]] = {}
        for number, term in enumerate(spelled[len(short) :], len(short)):
            known, begin = self._long.get(len(term), ([], number))
            self._long[len(term)] = ([*known, term], begin)
        self._long = {n: (np.array(known, f"S{n}"), begin) for n, (known, begin) in self._long.items()}

    def __len__(self) -> int:
        return len(self.first) - 1

    def lookup(self, found: T.Terms) -> tuple[np.ndarray, np.ndarray]:
        """The terms of some documents that the index knows: which they are, and their numbers in the index."""
        which, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        short = np.flatnonzero(found.length <= T.TWO_WORDS)
        if len(self._codes) and len(short):
            head, known = _place(self._heads, found.word(short, 0))
            short, head = short[known], head[known]
            tail, known = _place(self._tails, found.word(short, 8))
            short, head, tail = short[known], head[known], tail[known]
            at, known = _place(self._codes, head * len(self._tails) + tail)
            which.append(short[known])
            numbers.append(self._short[at[known]])
        if self._long:
            lengths = np.array(list(self._long))
            for some, rows in found.long_rows(np.flatnonzero(np.isin(found.length, lengths))):
                known_rows, begin = self._long[int(found.length[some[0]])]
                at, known = _place(known_rows, rows)
                which.append(some[known])
                numbers.append(begin + at[known])
        return np.concatenate(which), np.concatenate(numbers)


def _place(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value stands among ordered distinct ones, and whether it is there at all."""
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return at, ordered[at] == values


@dataclass
class Counts:
    """Terms per document, and how often each document holds each term of the index."""

    n: np.ndarray
    document: np.ndarray
    term: np.ndarray
    times: np.ndarray

    @staticmethod
    def of(found: T.Terms, index: Index) -> Counts:
        which, number = index.lookup(found)
        n = np.diff(found.first)
        keys, times = np.unique(found.document[which] * max(1, len(index)) + number, return_counts=True)
        document, term = np.divmod(keys, max(1, len(index)))
        return Counts(n, document, term, times.astype(np.int64))


@dataclass
class Statistics:
    """``documents`` with a term, all their ``terms``, and the ``weight`` of each term of the index."""

    documents: int
    terms: int
    weight: np.ndarray

    @staticmethod
    def of(documents: int, terms: int, holding: np.ndarray) -> Statistics:
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding]
        return Statistics(documents, terms, np.array(weight, np.int64))

    def damping(self, n: np.ndarray) -> np.ndarray:
        """What the length of a document takes off its term counts."""
        if len(n) and 90 * int(n.max()) * self.documents >= 1 << 63:
            return np.array([10 + 90 * int(one) * self.documents // self.terms for one in n], np.int64)
        return 10 + 90 * n * self.documents // self.terms


class Heaps:
    """The best documents of every item of an index so far."""

    def __init__(self, index: Index, statistics: Statistics, top: int) -> None:
        self._index, self._statistics, self._top = index, statistics, top
        self._heaps: list[list[tuple[int, float]]] = [[] for _ in index.items]
        #: The least score that may still get into each heap.
        self._least = np.ones(len(index.items), np.int64)
        # Doubles add up whole numbers exactly below 2^53, which a score stays under unless an item has very many terms.
        postings = np.repeat(statistics.weight, np.diff(index.first)).astype(np.float64) * 1e6
        most = np.bincount(index.holder, postings, len(index.items))
        self._doubles = not len(most) or most.max() < 1 << 52

    def add(self, ids: list[int | None], counts: Counts) -> None:
        """Score documents for all items; ``ids`` are theirs."""
        index, items = self._index, len(self._index.items)
        damping = self._statistics.damping(counts.n)[counts.document]
        score = self._statistics.weight[counts.term] * (10**9 * counts.times // (1000 * counts.times + 8 * damping))
        fan = np.diff(index.first)[counts.term]
        at, done = 0, np.concatenate([[0], np.cumsum(fan)])
        while at < len(score):
            # Whole documents, as many as keep scores and postings in bounds, one at least.
            low = int(counts.document[at])
            end = int(np.searchsorted(counts.document, low + max(1, CELLS // items)))
            end = min(end, int(np.searchsorted(done, done[at] + CELLS, "right")) - 1)
            whole = int(np.searchsorted(counts.document, counts.document[end])) if end < len(score) else end
            end = whole if whole > at else int(np.searchsorted(counts.document, low, "right"))
            some = slice(at, end)
            place = np.repeat(index.first[counts.term[some]] - (done[some] - done[at]), fan[some])
            cell = index.holder[place + np.arange(len(place))]
            cell += np.repeat((counts.document[some] - low) * items, fan[some])
            self._offer(ids, low, self._added(cell, np.repeat(score[some], fan[some]), items))
            at = end

    def _added(self, cell: np.ndarray, score: np.ndarray, items: int) -> np.ndarray:
        height = int(cell.max()) // items + 1 if len(cell) else 0
        if self._doubles:
            added = np.bincount(cell, score.astype(np.float64), height * items).astype(np.int64)
        else:
            added = np.zeros(height * items, np.int64)
            np.add.at(added, cell, score)
        return added.reshape(height, items)

    def _offer(self, ids: list[int | None], low: int, scores: np.ndarray) -> None:
        least = self._least
        if len(scores) > self._top:
            # Below the last of these documents' own best none gets in; equal scores are told apart by id.
            least = np.maximum(least, np.partition(scores, len(scores) - self._top, axis=0)[-self._top])
        for row, item in zip(*np.nonzero(scores >= least), strict=True):
            doc_id = ids[low + row]
            # The id, turned round, so that of equal scores the smallest id is best and none at all is worst.
            entry = (int(scores[row, item]), -math.inf if doc_id is None else -doc_id)
            heap = self._heaps[item]
            if len(heap) < self._top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self._top:
                self._least[item] = heap[0][0]

    def batch(self) -> pa.RecordBatch:
        """All that the heaps hold, as rows of ``MATCHES``."""
        rows = [
            (item, None if key == -math.inf else -key, score)
            for item, heap in zip(self._index.items, self._heaps, strict=True)
            for score, key in heap
        ]
        columns = [pa.array([row[k] for row in rows], pa.int64()) for k in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])


def _indexes(items: DataFrame) -> Iterator[Index]:
    """The items' terms as indexes of bounded size; all terms of an item are in one."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.explode(F.regexp_extract_all(lower, F.lit(TERM_PATTERN), F.lit(0)))
    pairs = items.select(F.col("item_id").cast("long"), terms.alias("term")).distinct()
    size = pairs.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
    passes = -(-size // INDEX_BYTES)
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(1, passes)))
    for n in range(passes):
        if rows := pairs.where(part == n).collect():
            yield Index([tuple(row) for row in rows])


def _counted(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[tuple[list[int | None], Counts]]:
    for batch in slices(batches):
        for at, found in T.of_texts(batch.column("text"), SEPARATOR):
            counts = Counts.of(found, index)
            ids = batch.column("doc_id").slice(at, len(counts.n)).to_pylist() if "doc_id" in batch.schema.names else []
            yield ids, counts


def statistics(docs: DataFrame, index: Index) -> Statistics:
    """One pass over the documents; what comes back has a row for each term of the index and two more."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last two places count documents and terms.
        sums = np.zeros(len(shared.value) + 2, np.int64)
        for _, counts in _counted(batches, shared.value):
            sums[:-2] += np.bincount(counts.term, minlength=len(shared.value))
            sums[-2:] += np.count_nonzero(counts.n), counts.n.sum()
        place = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(sums[place])], ["place", "number"])

    parts = docs.select("text").mapInArrow(run, "place long, number long")
    sums = np.zeros(len(index) + 2, np.int64)
    for row in parts.groupBy("place").agg(F.sum("number").alias("number")).collect():
        sums[row.place] = row.number
    shared.unpersist()
    return Statistics.of(int(sums[-2]), int(sums[-1]), sums[:-2])


def _matches(docs: DataFrame, index: Index, top: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((index, statistics(docs, index)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(*shared.value, top)
        for ids, counts in _counted(batches, shared.value[0]):
            heaps.add(ids, counts)
        yield heaps.batch()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MATCHES)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents of each item: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Rows of one item_id (NULL is
    one too) are one item, with the terms of all of them. A NULL or empty text has no terms: such an item has no
    result, such a document is in none and doesn't count. Each row of ``docs`` is a document of its own, also where
    ids or texts repeat. Rank is by score, equal scores by ascending doc_id, NULL last. Scores of 0 are left out. If
    either table is empty so is the result.

    The items go to the tasks in indexes of about ``INDEX_BYTES``, two passes over the documents each: what is
    broadcast, counted on the driver or kept by a task doesn't grow with either table. An item whose own distinct
    terms take more makes an index alone. Texts aren't moved; a task sends at most ``top`` rows for each item.
    """
    spark = docs.sparkSession
    found = [_matches(docs, index, top) for index in _indexes(items)]
    matches = reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], MATCHES)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    within = Window.partitionBy("item_id", "merge_group").orderBy(*best)
    merged = matches.withColumn("merge_group", group).withColumn("rank", F.row_number().over(within))
    merged = merged.filter(F.col("rank") <= top).drop("merge_group", "rank")
    ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
