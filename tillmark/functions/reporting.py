"""Report lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the line format of the outlier report.
OUTLIER_LINE_FORMAT = "User: %s, Invoice: %s, Product: %s, Quantity: %d, Median: %d"


def outlier_line() -> Column:
    """One outlier as a report line."""
    return F.format_string(
        OUTLIER_LINE_FORMAT, F.col("CustomerID"), F.col("InvoiceNo"), F.col("StockCode"), F.col("Quantity"),
        F.col("median_quantity"),
    )


def csv_line(*columns: str) -> Column:
    """Columns as one CSV line; NULL is empty."""
    return F.to_csv(F.struct(*columns))
