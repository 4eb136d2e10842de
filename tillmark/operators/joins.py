"""Join conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_key(left: Column, right: Column) -> Column:
    """``left == right`` for two keys of one type, in a form under which Spark can split a hot key at run time.

    A side that was aggregated by its key lies partitioned by it already, so Spark would join it where it lies. But it
    splits a hot partition of the other side only where both sides come from a shuffle made for the join. Stating the
    equality by hash as well makes it a join on two columns, for which a partitioning by one will not do. A broadcast
    join is not affected. The price is that shuffle: a side that is bucketed or partitioned by the key is shuffled
    too. Keys of different types would be compared as one type but hashed as two: use ``same_key`` for those.
    """
    return (F.xxhash64(left) == F.xxhash64(right)) & (left == right)


#: Types of which equal values have equal bytes, so that hashes tell them apart and nothing else.
_HASHED = (
    T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType,
    T.DateType, T.TimestampType, T.TimestampNTZType,
)


def _hashed(kind: T.DataType) -> bool:
    if isinstance(kind, T.StringType):
        # Under a collation texts of different bytes may be equal.
        return getattr(kind, "collation", "UTF8_BINARY") == "UTF8_BINARY"
    return isinstance(kind, _HASHED)


def _common_type(frame: DataFrame, left: T.DataType, right: T.DataType) -> T.DataType:
    nothing = frame.sparkSession.range(0).select(F.lit(None).cast(left).alias("l"), F.lit(None).cast(right).alias("r"))
    return nothing.select(F.coalesce("l", "r").alias("common")).schema["common"].dataType


def same_key(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> Column:
    """``left_key == right_key``, in a form under which Spark can split a hot key at run time (see ``split_key``).

    Keys of different types are brought to the type that Spark compares them in, before they are hashed; where there
    is none the comparison is an analysis error. Keys whose equality isn't that of their bytes (collated texts,
    floating point numbers, nested values) are compared alone, so their hot keys can only be split where Spark
    shuffles both sides anyway.
    """
    kinds = [frame.select(key.alias("key")).schema["key"].dataType for frame, key in ((left, left_key), (right, right_key))]
    if kinds[0] != kinds[1]:
        common = _common_type(left, *kinds)
        left_key, right_key, kinds = left_key.cast(common), right_key.cast(common), [common, common]
    return split_key(left_key, right_key) if all(map(_hashed, kinds)) else left_key == right_key
