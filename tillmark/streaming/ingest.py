"""Incremental ingest: each raw file is read once, and each of its rows is stored once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark import schemas
from tillmark.functions.dates import month_key
from tillmark.operators.bronze import parse_transactions
from tillmark.operators.reference_check import tag_by_reference
from tillmark.sinks import transactions
from tillmark.sinks.transactions import QUARANTINE, VALID


def store_batch(
    raw: DataFrame, countries: DataFrame, path: str, ingest_run: str, batch_id: int, reference: str | None = None
) -> dict[str, int]:
    """Parse, check and store one batch of raw transactions; returns its number of valid and quarantined rows.

    Valid and quarantined rows leave in one write, so the batch's files are scanned once. A batch that is run again
    after a failure takes the place of its first attempt as a whole: it leaves no row twice, not even if the country
    table has changed in between. Rows are rebalanced by the storage folders, so that thousands of one-invoice files
    become few files per month and a month that holds most rows is split; within a file they lie in order of time.

    ``reference`` names the stored keys of ``countries`` where the caller has stored them already.
    """
    spark = raw.sparkSession
    if transactions.is_merged(spark, path, ingest_run, batch_id):
        return {VALID: 0, QUARANTINE: 0}
    reference = reference or transactions.reference_of(path, countries)
    checked = tag_by_reference(parse_transactions(raw), countries, "CountryID", "_valid")
    stored = checked.select(
        *schemas.TRANSACTIONS.names,
        F.when(F.col("_valid"), F.lit(VALID)).otherwise(F.lit(QUARANTINE)).alias("quality"),
        month_key(F.col("InvoiceTimestamp")).alias("invoice_month"),
    )
    histogram = transactions.add_batch(stored, path, reference, ingest_run, batch_id)
    return transactions.batch_counts(spark, path, histogram)


def ingest_new_files(raw: DataFrame, countries: DataFrame, path: str, checkpoint: str) -> dict[str, int]:
    """Store all files of the stream ``raw`` that the checkpoint has not seen, then stop.

    Returns the number of batches and of valid and quarantined rows that this call stored, counted in the stored files
    so that retried tasks do not count twice. Batches' folders stay as they are until ``compact_transactions``.
    """
    spark = raw.sparkSession
    name = f"ingest-{uuid.uuid4().hex}"
    counts = {"batches": 0, VALID: 0, QUARANTINE: 0}
    reference = transactions.reference_of(path, countries)

    def store(batch: DataFrame, batch_id: int) -> None:
        # Batch ids start at 0 with every new checkpoint. The id of the query is kept in the checkpoint, so it stays
        # the same over restarts and is another one for another checkpoint: the two together name a batch.
        ingest_run = next(query.id for query in spark.streams.active if query.name == name)
        stored = store_batch(batch, countries, path, ingest_run, batch_id, reference)
        counts["batches"] += 1
        for quality, count in stored.items():
            counts[quality] += count

    query = (
        raw.writeStream.foreachBatch(store)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return counts


def compact_transactions(spark: SparkSession, path: str, fan_in: int = transactions.FAN_IN) -> int:
    """Merge the folders of many small batches and clear away what old versions and dead writes have left."""
    merges = transactions.compact(spark, path, fan_in)
    transactions.tidy(spark, path)
    return merges


def replay_countries(countries: DataFrame, path: str) -> dict[str, int]:
    """Move stored rows between valid and quarantine as ``countries`` says now; returns how many went to either."""
    return transactions.replay(countries, path)
