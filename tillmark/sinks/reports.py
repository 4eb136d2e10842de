"""Report files. Each report is a folder written by many tasks; an empty report is a folder without lines.

A report is written beside the old one and takes its place when it is whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from tillmark import storage
from tillmark.operators.alerts import INVALID_COUNTRY_COLUMNS, outlier_lines


def _replace(df: DataFrame, path: str, write: Callable[[DataFrame, str], None]) -> None:
    folder, _, name = path.rstrip("/").rpartition("/")
    staged = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        write(df, staged)
        storage.replace_folder(df.sparkSession, staged, path.rstrip("/"))
    finally:
        storage.remove(df.sparkSession, staged)


def write_outlier_report(outliers: DataFrame, path: str) -> None:
    """One text line per outlier."""
    _replace(outlier_lines(outliers), path, lambda df, staged: df.write.text(staged))


def write_invalid_country_report(invalid: DataFrame, path: str) -> None:
    """CSV with a header line."""
    lines = invalid.select(*INVALID_COUNTRY_COLUMNS)
    _replace(lines, path, lambda df, staged: df.write.option("header", True).csv(staged))
