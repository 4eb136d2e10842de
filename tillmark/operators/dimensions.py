"""The four dimensions of the star schema.

Each is a ``distinct`` over the few columns it needs, so tasks drop duplicates before the shuffle and a key that holds
most of the rows arrives at its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import date_key
from tillmark.functions.parsing import whole_number


def dim_date(transactions: DataFrame) -> DataFrame:
    """One row per calendar day with a transaction; one NULL row if some timestamp could not be parsed."""
    days = transactions.select(F.to_date("InvoiceTimestamp").alias("full_date")).distinct()
    day = F.col("full_date")
    return days.select(
        day,
        date_key(day).alias("date_id"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )


def dim_customers(transactions: DataFrame) -> DataFrame:
    """One row per customer: the raw id and its int form (NULL where it is not numeric)."""
    customers = transactions.select("CustomerID").distinct()
    return customers.withColumn("customer_id", whole_number(F.col("CustomerID")))


def dim_products(products: DataFrame) -> DataFrame:
    """One row per (product, description): a product described in two ways has two rows."""
    return products.select(
        F.col("StockCode").alias("product_id"), F.col("ProductDescription").alias("description")
    ).distinct()


def dim_geography(countries: DataFrame) -> DataFrame:
    return countries.select(
        F.col("CountryID").alias("geo_id"),
        F.col("CountryName").alias("country"),
        F.col("ContinentName").alias("continent"),
    ).distinct()
