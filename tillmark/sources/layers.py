"""Tables that the jobs have written: Parquet folders of a lake, or catalog tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schemas, versions
from tillmark.sinks import transactions
from tillmark.sinks.transactions import QUARANTINE, VALID


def read_layer(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The Parquet table ``<root>/<name>`` in its latest version, or as a plain folder where it has no versions; the
    catalog table ``name`` where no root is given."""
    if root is None:
        return spark.table(name)
    version = versions.latest(spark, f"{root}/{name}")
    return versions.read(spark, f"{root}/{name}", version) if version.number else spark.read.parquet(f"{root}/{name}")


def exists(read: Callable[[], DataFrame]) -> bool:
    """Whether the folder or table that ``read`` opens is there; any other trouble is raised."""
    try:
        read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return False
        raise
    return True


def _ingested(spark: SparkSession, path: str, quality: str, since: dt.date | None) -> DataFrame:
    # The filter on the month prunes folders. The filter on the timestamp reaches the Parquet reader, which skips row
    # groups by it: files are stored in order of time.
    where = None
    if since is not None:
        month = since.year * 100 + since.month
        where = (F.col("invoice_month") >= month) & (F.col("InvoiceTimestamp") >= F.lit(since))
    return transactions.read_transactions(spark, path, quality, where).select(*schemas.TRANSACTIONS.names)


def read_valid_transactions(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Ingested transactions that passed the country check; with ``since``, only those of that day or later."""
    return _ingested(spark, path, VALID, since)


def read_quarantine(spark: SparkSession, path: str, since: dt.date | None = None) -> DataFrame:
    """Ingested transactions that failed the country check."""
    return _ingested(spark, path, QUARANTINE, since)


def read_quantity_histogram(spark: SparkSession, path: str) -> DataFrame:
    """How often each quantity of each product was ordered, of all valid transactions, as the ingest keeps it."""
    return transactions.read_histogram(spark, path, VALID)
