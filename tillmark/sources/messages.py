"""Message logs with the columns of Spark's Kafka source."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schemas

#: The offset to read from, by topic and partition.
Offsets = Mapping[tuple[str, int], int]

#: How Kafka's connector calls the first offset that a partition still has.
EARLIEST = -2


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str | int) -> DataFrame:
    """All messages of a topic, from the earliest to the latest at the time of the read.

    Needs Spark's Kafka connector on the class path. ``options`` are those of the connector: ``minPartitions`` splits
    the partitions of a large topic over more tasks.
    """
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**{"startingOffsets": "earliest", "endingOffsets": "latest", **options}).load()


def stream_topic(spark: SparkSession, servers: str, topic: str, **options: str | int) -> DataFrame:
    """The same topic as a stream, from the earliest message on."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**options).load()


def starting_offsets(topic: str, offsets: Offsets, partitions: int) -> str:
    """The connector's JSON for offsets of one topic; it wants every partition named, so also those not read so far."""
    known = {partition: offset for (name, partition), offset in offsets.items() if name == topic}
    every = sorted({*range(partitions), *known})
    return json.dumps({topic: {str(partition): known.get(partition, EARLIEST) for partition in every}})


def read_topic_from(
    spark: SparkSession, servers: str, topic: str, offsets: Offsets, partitions: int, **options: str | int
) -> DataFrame:
    """The messages of a topic from ``offsets`` to the latest at the time of the read.

    ``partitions`` is how many the topic has now. Messages that the broker no longer keeps make the read fail, unless
    ``options`` has ``failOnDataLoss`` as false.
    """
    if not offsets:
        return read_topic(spark, servers, topic, **options)
    return read_topic(spark, servers, topic, **options, startingOffsets=starting_offsets(topic, offsets, partitions))


def read_archive_from(spark: SparkSession, path: str, offsets: Offsets) -> DataFrame:
    """Archived messages from ``offsets`` on, of partitions that aren't named all.

    The condition is one comparison per partition, so it reaches the Parquet reader, which skips older files and row
    groups by it. The archive must hold a partition's messages once each and be filled in order of offset.
    """
    log = read_archive(spark, path)
    topic, partition, offset = F.col("topic"), F.col("partition"), F.col("offset")
    new = [
        (topic != name) | (partition != number) | (offset >= following)
        for (name, number), following in sorted(offsets.items())
    ]
    while len(new) > 1:
        # In pairs, so that the condition is as deep as the logarithm of the number of partitions.
        new = [one & other for one, other in zip(new[::2], new[1::2])] + new[len(new) & ~1 :]
    # Rows that no comparison can judge stay, for the caller to refuse.
    return log.filter(new[0] | topic.isNull() | partition.isNull() | offset.isNull()) if new else log


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Messages kept as Parquet files with the same columns."""
    return spark.read.schema(schemas.MESSAGES).parquet(path)


def stream_archive(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    return spark.readStream.schema(schemas.MESSAGES).options(**options).parquet(path)
