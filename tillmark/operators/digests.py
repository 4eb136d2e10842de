"""Digests of whole frames, by which rows in any order are compared without being moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(df: DataFrame) -> tuple[Column, ...]:
    """Number of rows, and sum and exclusive or of two hashes of the rows, which no order of rows changes."""
    columns = [F.col(f"`{name}`") for name in df.columns]
    # A hash passes over NULLs, so it is told where they are.
    row = [*columns, *(column.isNull() for column in columns)]
    return (
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(F.xxhash64(F.lit(1), *row).cast("decimal(20,0)")).cast("string"), F.lit("0")).alias("total"),
        F.coalesce(F.bit_xor(F.xxhash64(F.lit(2), *row)), F.lit(0)).alias("parity"),
    )
