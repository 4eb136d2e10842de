"""The alert digest over the outlier and the invalid-country report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.reporting import csv_line, outlier_line

# The alerts and what each says when there is nothing to report.
OUTLIER_ALERT = ("High-Value Orders", "No high-value order anomalies detected.")
COUNTRY_ALERT = ("Invalid CountryID Transactions", "No invalid CountryID transactions detected.")

# Fixed value: the columns of the invalid-country report.
INVALID_COUNTRY_COLUMNS = ("InvoiceNo", "StockCode", "Quantity", "CustomerID", "CountryID")


def outlier_lines(outliers: DataFrame) -> DataFrame:
    return outliers.select(outlier_line().alias("line"))


def invalid_country_lines(invalid: DataFrame) -> DataFrame:
    return invalid.select(csv_line(*INVALID_COUNTRY_COLUMNS).alias("line"))


def alert_digest(outliers: DataFrame, invalid: DataFrame) -> DataFrame:
    """One row per alert: how many rows it concerns and a message, which is the fallback text if there are none."""

    def summary(report: DataFrame, title: str, fallback: str) -> DataFrame:
        found = F.col("row_count")
        message = F.when(found == 0, F.lit(fallback)).otherwise(F.format_string("%d rows detected.", found))
        return report.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(title).alias("alert"), found, message.alias("message")
        )

    return summary(outliers, *OUTLIER_ALERT).unionAll(summary(invalid, *COUNTRY_ALERT))


def alert_lines(outliers: DataFrame, invalid: DataFrame) -> DataFrame:
    """The body of the digest: every line of both reports, or the fallback text of a report without lines."""

    def body(lines: DataFrame, title: str, fallback: str) -> list[DataFrame]:
        nothing = lines.agg(F.count(F.lit(1)).alias("row_count")).filter("row_count = 0")
        return [
            lines.select(F.lit(title).alias("alert"), "line"),
            nothing.select(F.lit(title).alias("alert"), F.lit(fallback).alias("line")),
        ]

    parts = body(outlier_lines(outliers), *OUTLIER_ALERT) + body(invalid_country_lines(invalid), *COUNTRY_ALERT)
    return reduce(DataFrame.unionAll, parts)
