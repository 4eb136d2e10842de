"""Rows whose key is, or is not, in a reference table.

No join here carries a broadcast hint: Spark broadcasts the reference side only while its known size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting a hot key (or a large group of NULL keys)
at run time. None can multiply rows, however often a key occurs in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.operators.joins import same_key

_REFERENCE_KEY = "_reference_key"
_LISTED = "_listed"


def _existence_join(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None, how: str) -> DataFrame:
    # A renamed key and a plain condition keep the column order of df; a USING join would move the key to the front.
    keys = reference.select(F.col(reference_key or key).alias(_REFERENCE_KEY))
    return df.join(keys, same_key(df, F.col(key), keys, F.col(_REFERENCE_KEY)), how)


def in_reference(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``reference``."""
    return _existence_join(df, reference, key, reference_key, "left_semi")


def missing_reference(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``reference``; a NULL key never does."""
    return _existence_join(df, reference, key, reference_key, "left_anti")


def split_by_reference(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``: together exactly the rows of ``df``. Each is a plan of its own over ``df``."""
    return (
        in_reference(df, reference, key, reference_key),
        missing_reference(df, reference, key, reference_key),
    )


def tag_by_reference(df: DataFrame, reference: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` plus a boolean ``flag``, for jobs that write both sides of the split in one pass over ``df``."""
    keys = reference.select(F.col(key).alias(_REFERENCE_KEY)).distinct().withColumn(_LISTED, F.lit(True))
    joined = df.join(keys, same_key(df, F.col(key), keys, F.col(_REFERENCE_KEY)), "left")
    return joined.select(*df.columns, F.coalesce(_LISTED, F.lit(False)).alias(flag))
