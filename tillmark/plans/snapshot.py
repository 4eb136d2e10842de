"""Timestamped copies of the lake."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "manifest"


def snapshot(spark: SparkSession, tables: Mapping[str, DataFrame], destination: str, stamp: str) -> DataFrame:
    """Copy every table to ``<destination>/<stamp>/<table>`` as Parquet.

    Returns the manifest, stored beside the copies: table, number of rows and schema, as read back from the copies.
    """
    folder = f"{destination}/{stamp}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")

    def entry(name: str) -> DataFrame:
        copy = spark.read.parquet(f"{folder}/{name}")
        return copy.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(copy.schema.simpleString()).alias("table_schema")
        )

    manifest = reduce(DataFrame.unionAll, [entry(name) for name in tables])
    manifest.write.parquet(f"{folder}/{MANIFEST}")
    return spark.read.parquet(f"{folder}/{MANIFEST}")
