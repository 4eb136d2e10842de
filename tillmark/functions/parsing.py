"""Typed columns out of raw text. Unparseable text becomes NULL and the row is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats and the separator of the raw files.
INVOICE_DATE_FORMAT = "dd/MM/yyyy HH:mm"
PRICE_DATE_FORMAT = "yyyy-MM-dd"
PRICE_TYPE = "decimal(10,2)"
COUNTRY_SEPARATOR = "-"


def invoice_timestamp(invoice_date: Column) -> Column:
    return F.try_to_timestamp(invoice_date, F.lit(INVOICE_DATE_FORMAT))


def country_id(country: Column) -> Column:
    """The country of ``<country>-<region>``: all text before the first separator."""
    return F.substring_index(country, COUNTRY_SEPARATOR, 1)


def region_id(country: Column) -> Column:
    """The region of ``<country>-<region>``: the second part, NULL where there is none. Further parts are ignored."""
    return F.get(F.split(country, COUNTRY_SEPARATOR), F.lit(1))


def whole_number(text: Column) -> Column:
    """Text as an int, without its decimals ("17850.0" is 17850); NULL for text that is no number or does not fit.

    White space around the number doesn't matter. A lone point is no number and gives NULL.
    """
    return F.regexp_replace(text, r"\.[0-9]*\s*$", "").try_cast("int")


def unit_price(price: Column) -> Column:
    """Rounds half up to two decimals; NULL for text that is no number or does not fit."""
    return price.try_cast(PRICE_TYPE)


def price_date(date: Column) -> Column:
    return F.try_to_date(date, PRICE_DATE_FORMAT)


def message_text(value: Column) -> Column:
    """The UTF-8 text of a message's binary value."""
    return value.cast("string")
