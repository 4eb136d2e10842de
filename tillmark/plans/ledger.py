"""Trends kept with a ledger of offsets: a run reads the messages that no run before it has counted.

The ledger is a table of versions (see ``versions``). Its rows are the messages per product so far; its version file
says up to which offset of each partition they were counted. Both change by one commit, so a run that dies leaves
neither, and a run that is repeated finds nothing to count again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schemas, storage, versions
from tillmark.functions.keywords import PRODUCT_KEYWORDS, product_mention
from tillmark.functions.parsing import message_text
from tillmark.operators.trends import TOP, top_mentions
from tillmark.plans.trending import TABLE, Write
from tillmark.sinks.metrics import write_counted
from tillmark.sources.messages import Offsets

#: Gives the messages from the given offsets on; partitions that aren't named from their first one.
Read = Callable[[Offsets], DataFrame]


def _fingerprint(keywords: Sequence[tuple[str, str]]) -> str:
    return hashlib.sha256(json.dumps([list(pair) for pair in keywords]).encode()).hexdigest()


def _offsets(content: dict) -> Offsets:
    return {(topic, partition): following for topic, partition, following in content.get("offsets", [])}


def count_ranges(messages: DataFrame, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS) -> DataFrame:
    """Messages and last offset per topic, partition and product (NULL where none is mentioned).

    A message without topic, partition or offset raises an error, as it could not be told from one already counted.
    """
    placed = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return (
        messages.select(
            "topic",
            "partition",
            F.when(placed, F.col("offset")).otherwise(
                F.raise_error(F.lit("a message has no topic, partition or offset"))
            ).alias("offset"),
            product_mention(message_text(F.col("value")), keywords).alias("product_mention"),
        )
        .groupBy("topic", "partition", "product_mention")
        .agg(F.count(F.lit(1)).alias("count"), F.max("offset").alias("last_offset"))
    )


def counted_offsets(spark: SparkSession, path: str) -> Offsets:
    """The offset that follows the last one counted, by topic and partition."""
    return _offsets(versions.latest(spark, path).content)


def mention_totals(spark: SparkSession, path: str) -> DataFrame:
    """Messages per product over all that the ledger has counted."""
    return versions.read(spark, path)


def count_new(
    spark: SparkSession, read: Read, path: str, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS
) -> int:
    """Count the messages that came since the last call on the ledger ``path``; returns how many there were.

    They are read once: the write of their counts fixes where the read ends, and the ends are taken from what was
    written. Through the driver goes one row per partition of the log. A ledger that was counted with other keywords is
    counted anew from the first message. Of two runs at a time one gets ``VersionConflict`` and has counted nothing.
    """
    before = versions.latest(spark, path)
    same = before.content.get("keywords") == _fingerprint(keywords)
    offsets = _offsets(before.content) if same else {}
    folder = versions.new_folder()
    ranges = f"{path}/{folder}/ranges"
    found = count_ranges(read(offsets), keywords)
    found.write.parquet(ranges)
    found = spark.read.schema(found.schema).parquet(ranges)
    ends = found.groupBy("topic", "partition").agg(
        F.sum("count").alias("count"), (F.max("last_offset") + 1).alias("following")
    ).collect()
    if before.number and same and not ends:
        storage.remove(spark, f"{path}/{folder}")
        return 0
    new = found.filter(F.col("product_mention").isNotNull()).select("product_mention", "count")
    totals = new.unionAll(versions.read(spark, path, before)) if offsets else new
    totals = totals.groupBy("product_mention").agg(F.sum("count").alias("count"))
    totals.write.parquet(f"{path}/{folder}/totals")
    offsets = {**offsets, **{(row["topic"], row["partition"]): row["following"] for row in ends}}
    content = {
        "parts": [f"{folder}/totals"],
        "schema": schemas.TRENDING_PRODUCTS.jsonValue(),
        "offsets": sorted([topic, partition, following] for (topic, partition), following in offsets.items()),
        "keywords": _fingerprint(keywords),
    }
    versions.commit(spark, path, content, before)
    storage.remove(spark, ranges)
    versions.tidy(spark, path, lambda kept: {part.split("/")[0] for part in kept["parts"]})
    return sum(row["count"] for row in ends)


def refresh_from_ledger(
    spark: SparkSession,
    read: Read,
    write: Write,
    path: str,
    keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS,
    n: int = TOP,
) -> dict[str, int]:
    """Count what is new and replace the trend table; a run that died between the two is made good by the next one."""
    new = count_new(spark, read, path, keywords)
    ranked = top_mentions(mention_totals(spark, path), n)
    return {"new_messages": new, TABLE: write_counted(ranked, lambda df: write(df, TABLE))}
