"""Small hand-made bronze frames."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from tillmark import schemas
from tillmark.operators import bronze


def transactions(spark, rows):
    """``rows`` of invoice, product, quantity, invoice date text, customer and country text."""
    return bronze.parse_transactions(spark.createDataFrame(rows, schemas.RAW_TRANSACTIONS))


def prices(spark, rows):
    """``rows`` of product, description, price text and day text."""
    typed = [
        (code, name, price and Decimal(price), day and dt.date.fromisoformat(day)) for code, name, price, day in rows
    ]
    return spark.createDataFrame(typed, schemas.PRODUCTS)


def countries(spark, rows):
    return bronze.countries(spark.createDataFrame(rows, schemas.RAW_COUNTRIES))
