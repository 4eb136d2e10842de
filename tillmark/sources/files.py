"""Raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillmark import schemas


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV lines of six fields, leniently: a bad number or missing trailing field is NULL, extra fields are
    dropped and blank lines skipped."""
    return spark.read.schema(schemas.RAW_TRANSACTIONS).csv(path)


def stream_transactions(spark: SparkSession, path: str, **options: str | int) -> DataFrame:
    """The same files as a stream, each read once. ``options`` are those of Spark's file source, such as
    ``maxFilesPerTrigger``, ``maxBytesPerTrigger`` or ``cleanSource``."""
    return spark.readStream.schema(schemas.RAW_TRANSACTIONS).options(**options).csv(path)


def _read_with_header(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    # Columns are found by the names in the header, whatever their order, and stay text.
    return spark.read.option("header", True).csv(path).select(*columns)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    return _read_with_header(spark, path, schemas.RAW_COUNTRIES.names)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Prices per product and day."""
    return _read_with_header(spark, path, schemas.RAW_PRODUCTS.names)
