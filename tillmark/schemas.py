"""Schemas of the raw inputs and of the tables that the jobs write."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


PRICE = T.DecimalType(10, 2)
LINE_TOTAL = T.DecimalType(21, 2)
SALES_TOTAL = T.DecimalType(31, 2)

# --- raw inputs -------------------------------------------------------------------------------------------------

RAW_TRANSACTIONS = _struct(
    ("InvoiceNo", T.StringType()),
    ("StockCode", T.StringType()),
    ("Quantity", T.IntegerType()),
    ("InvoiceDate", T.StringType()),
    ("CustomerID", T.StringType()),
    ("Country", T.StringType()),
)
RAW_COUNTRIES = _struct(("CountryID", T.StringType()), ("CountryName", T.StringType()))
RAW_PRODUCTS = _struct(
    ("StockCode", T.StringType()),
    ("ProductDescription", T.StringType()),
    ("UnitPrice", T.StringType()),
    ("Date", T.StringType()),
)
MESSAGES = _struct(
    ("key", T.BinaryType()),
    ("value", T.BinaryType()),
    ("topic", T.StringType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
    ("timestampType", T.IntegerType()),
)

# --- bronze -----------------------------------------------------------------------------------------------------

TRANSACTIONS = T.StructType(
    RAW_TRANSACTIONS.fields
    + _struct(
        ("InvoiceTimestamp", T.TimestampType()), ("CountryID", T.StringType()), ("RegionID", T.StringType())
    ).fields
)
COUNTRIES = T.StructType(
    RAW_COUNTRIES.fields + _struct(("ContinentID", T.IntegerType()), ("ContinentName", T.StringType())).fields
)
PRODUCTS = _struct(
    ("StockCode", T.StringType()),
    ("ProductDescription", T.StringType()),
    ("UnitPrice", PRICE),
    ("Date", T.DateType()),
)

#: How ingested transactions lie on disk: the columns above plus these, used as folders.
TRANSACTION_STORAGE = T.StructType(
    TRANSACTIONS.fields
    + _struct(("data", T.StringType()), ("quality", T.StringType()), ("invoice_month", T.IntegerType())).fields
)

#: How often each quantity of a product was ordered, among valid and among quarantined rows.
QUANTITY_HISTOGRAM = _struct(
    ("quality", T.StringType()), ("group_key", T.StringType()), ("level", T.IntegerType()), ("row_count", T.LongType())
)

# --- gold -------------------------------------------------------------------------------------------------------

DIM_DATE = _struct(
    ("full_date", T.DateType()),
    ("date_id", T.IntegerType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
)
DIM_CUSTOMERS = _struct(("CustomerID", T.StringType()), ("customer_id", T.IntegerType()))
DIM_PRODUCTS = _struct(("product_id", T.StringType()), ("description", T.StringType()))
DIM_GEOGRAPHY = _struct(("geo_id", T.StringType()), ("country", T.StringType()), ("continent", T.StringType()))
FCT_SALES = _struct(
    ("sale_id", T.StringType()),
    ("invoice_no", T.StringType()),
    ("date_id", T.IntegerType()),
    ("customer_id", T.StringType()),
    ("product_id", T.StringType()),
    ("geo_id", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", PRICE),
    ("total_price", LINE_TOTAL),
)
TRENDING_PRODUCTS = _struct(("product_mention", T.StringType()), ("count", T.LongType()))
