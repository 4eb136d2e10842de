"""The trend report over a stream of messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillmark.functions.keywords import PRODUCT_KEYWORDS
from tillmark.operators.trends import TOP, mention_counts, top_mentions


def start_trends(
    messages: DataFrame,
    write: Callable[[DataFrame], None],
    checkpoint: str,
    keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS,
    n: int = TOP,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the trend table current: after every batch ``write`` gets the whole table and replaces the old one.

    The state is one count per product, so it needs no watermark. It is spread over ``spark.sql.shuffle.partitions``
    of the session that made ``messages``; a few are enough. ``trigger`` takes the arguments of
    ``DataStreamWriter.trigger`` and by default works off what there is and stops.
    """
    counts = mention_counts(messages, keywords)
    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: write(top_mentions(batch, n)))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
