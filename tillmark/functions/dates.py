"""Calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(date: Column) -> Column:
    """``yyyyMMdd`` of a date as an int, by arithmetic so that no text is made per row."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def month_key(date: Column) -> Column:
    """``yyyyMM`` of a date or timestamp as an int."""
    return F.year(date) * 100 + F.month(date)
