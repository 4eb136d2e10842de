"""Counts as a by-product of a write, in place of further jobs over the same plan, and the table that keeps them."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark import versions

METRICS = "run long, table_name string, metric string, value long"

ROW_COUNT = "row_count"


def write_measured(df: DataFrame, write: Callable[[DataFrame], None], tests: dict[str, Column]) -> dict[str, int]:
    """Run ``write`` on ``df`` and return how many rows it wrote and for how many each of ``tests`` holds."""
    observation = Observation()
    counted = [F.count_if(test).alias(name) for name, test in tests.items()]
    write(df.observe(observation, F.count(F.lit(1)).alias(ROW_COUNT), *counted))
    try:
        return dict(observation.get)
    except Py4JJavaError as error:
        # Where Spark finds at run time that there are no rows, it drops the plan and the observation with it.
        if "assertion failed" not in str(error):
            raise
        return dict.fromkeys([ROW_COUNT, *tests], 0)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return how many rows it wrote."""
    return write_measured(df, write, {})[ROW_COUNT]


def record(spark: SparkSession, path: str, measured: dict[str, dict[str, int]], attempts: int = 20) -> int:
    """Add a run to the metrics kept at ``path`` and return its number; ``measured`` has the counts of each table.

    A run's number is that of the version that adds it, so two writers never share one, and a call that dies adds
    nothing. The table is written whole each time: it has one row per run, table and count.
    """
    for _ in range(attempts):
        before = versions.latest(spark, path)
        run, folder = before.number + 1, versions.new_folder()
        new = [(run, table, metric, value) for table, counts in measured.items() for metric, value in counts.items()]
        rows = spark.createDataFrame(new, METRICS)
        kept = rows.unionAll(versions.read(spark, path, before)) if before.number else rows
        kept.coalesce(1).write.parquet(f"{path}/{folder}")
        try:
            versions.commit(spark, path, {"parts": [folder], "schema": rows.schema.jsonValue()}, before)
        except versions.VersionConflict:
            continue
        versions.tidy(spark, path)
        return run
    raise versions.VersionConflict(f"{path} is changed by others all the time")
