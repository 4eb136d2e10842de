"""Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter

from tillmark import storage, versions

#: How Parquet layers are compressed: the fact takes a third less than by Spark's default.
COMPRESSION = "zstd"


def write_layer(
    df: DataFrame,
    name: str,
    root: str | None = None,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write the Parquet table ``<root>/<name>``, or the managed catalog table ``name`` where no root is given.

    ``mode`` is ``overwrite`` for a full refresh or ``append``. Partitioned output is first rebalanced by the
    partition columns, which gives each folder few files of even size and splits a folder that holds most rows. Each
    file is ordered by ``sort_by``, so that readers skip parts of it by those columns. ``derive`` adds, behind that
    shuffle, columns that are functions of others, so that it needn't carry them.

    A table under a root that isn't partitioned changes from version to version (see ``versions``): a write that fails
    midway leaves the old rows, and a reader that has opened them finishes. Old versions are removed after a day. A
    partitioned table is a plain folder, as is one that something else wrote: appending to it adds files there.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df = derive(df) if derive else df
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)

    def writer(frame: DataFrame) -> DataFrameWriter:
        return frame.write.mode(mode).format("parquet").option("compression", COMPRESSION).partitionBy(*partition_by)

    if root is None:
        writer(df).saveAsTable(name)
        return
    path, spark = f"{root}/{name}", df.sparkSession
    append = mode == "append"
    if partition_by or append and storage.exists(spark, path) and not versions.numbers(spark, path):
        writer(df).save(path)
    else:
        versions.publish(df, path, lambda frame, folder: writer(frame).save(folder), append)
        versions.tidy(spark, path)
