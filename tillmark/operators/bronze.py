"""Raw frames to typed bronze frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions import geography, parsing


def parse_transactions(raw: DataFrame) -> DataFrame:
    """The raw columns plus ``InvoiceTimestamp``, ``CountryID`` and ``RegionID``."""
    return raw.withColumns(
        {
            "InvoiceTimestamp": parsing.invoice_timestamp(F.col("InvoiceDate")),
            "CountryID": parsing.country_id(F.col("Country")),
            "RegionID": parsing.region_id(F.col("Country")),
        }
    )


def countries(raw: DataFrame) -> DataFrame:
    """The raw columns plus ``ContinentID`` and ``ContinentName``."""
    return raw.withColumn("ContinentID", geography.continent_id(F.col("CountryID"))).withColumn(
        "ContinentName", geography.continent_name(F.col("ContinentID"))
    )


def products(raw: DataFrame) -> DataFrame:
    """One price per product and day, typed."""
    return raw.withColumns(
        {"UnitPrice": parsing.unit_price(F.col("UnitPrice")), "Date": parsing.price_date(F.col("Date"))}
    )
