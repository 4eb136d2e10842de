"""The trend table, stored."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tillmark import storage

from tillmark.functions.keywords import PRODUCT_KEYWORDS
from tillmark.operators.trends import TOP, trending_products
from tillmark.sinks.metrics import write_counted
from tillmark.streaming.trends import start_trends

TABLE = "trending_products"

Write = Callable[[DataFrame, str], None]


def refresh_trends(
    messages: DataFrame, write: Write, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS, n: int = TOP
) -> dict[str, int]:
    """Replace the trend table by one over all of ``messages``; the messages are read once."""
    ranked = trending_products(messages, keywords, n)
    return {TABLE: write_counted(ranked, lambda df: write(df, TABLE))}


def follow_trends(
    messages: DataFrame,
    write: Write,
    checkpoint: str,
    keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS,
    n: int = TOP,
    every: str | None = None,
    stop: Callable[[], bool] = lambda: False,
    poll_seconds: float = 1.0,
) -> None:
    """Bring the trend table up to date with the messages that came since the last call on the same checkpoint.

    Without ``every`` it works off what there is and returns. With an interval like ``10 seconds`` it goes on, a batch
    per interval, until ``stop()`` is true. A batch that the stop cuts short is run again by the next call; as it
    replaces the whole table, nothing counts twice. A batch that fails raises here.
    """
    trigger = {"processingTime": every} if every else None
    query = start_trends(messages, lambda df: write(df, TABLE), checkpoint, keywords, n, trigger)
    if not every:
        query.awaitTermination()
        return
    try:
        while not query.awaitTermination(poll_seconds):
            if stop():
                break
    finally:
        query.stop()


def stop_when(messages: DataFrame, file: str | None = None, seconds: float | None = None) -> Callable[[], bool]:
    """A condition for ``follow_trends``: that ``file`` is there, or that so many seconds have passed."""
    spark, start = messages.sparkSession, time.monotonic()

    def stop() -> bool:
        late = seconds is not None and time.monotonic() - start >= seconds
        return late or file is not None and storage.exists(spark, file)

    return stop
