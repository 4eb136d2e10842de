"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")

#: Learning leaves out the documents of this fold.
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a NULL id counts as an empty text and is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def chunks(items: Iterable[T], size: int) -> Iterator[list[T]]:
    chunk: list[T] = []
    for item in items:
        chunk.append(item)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def slices(batches: Iterable[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes, so that what is made of one stays small."""
    for batch in batches:
        step = max(1, int(batch.num_rows * size / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
        give_back()


def give_back() -> None:
    """Hand freed memory back to the system, else a worker keeps what its largest batch took beside the next stage's.

    Arrow's pool and numpy's arrays are apart: the latter lie in the heap of the C library, which GNU's can trim.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, for ``mapInArrow``, that gives its memory back when the partition is done and its arrays are gone."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return over


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to differ from all columns of ``frame``."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
