"""The sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.dates import date_key
from tillmark.operators.joins import same_key


def _invoice_day() -> Column:
    return F.to_date("InvoiceTimestamp")


def _daily_prices(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("StockCode").alias("price_product"), F.col("Date").alias("price_day"), F.col("UnitPrice")
    )


def _same_product_and_day(transactions: DataFrame, prices: DataFrame) -> Column:
    same_product = same_key(transactions, F.col("StockCode"), prices, F.col("price_product"))
    return same_product & (_invoice_day() == F.col("price_day"))


def fct_sales(
    transactions: DataFrame, products: DataFrame, geography: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """The fact: ``priced_sales`` with all columns."""
    return with_derived(priced_sales(transactions, products, geography, dates))


def priced_sales(
    transactions: DataFrame, products: DataFrame, geography: DataFrame, dates: DataFrame | None = None
) -> DataFrame:
    """Transactions priced by product and calendar day.

    A transaction with no price for its day is left out (see ``unpriced_sales``); a day priced twice yields two rows.
    ``sale_id`` is a label, not a key: an invoice may list a product twice. It and ``total_price`` are left to
    ``with_derived``, so that a shuffle in between needn't carry them.

    The price table grows with products times days, so it is joined without a hint: a shuffle join whose hot
    (product, day) partitions Spark splits at run time, or a broadcast once the measured size allows it. ``date_id``
    is a function of the invoice day, so by default it is computed in place; that saves building ``dim_date`` (a pass
    over all transactions) and a join. Give ``dates`` to look it up there instead.
    """
    prices = _daily_prices(products)
    sales = transactions.join(prices, _same_product_and_day(transactions, prices), "inner")
    if dates is None:
        date_id = date_key(_invoice_day())
    else:
        same_day = same_key(sales, _invoice_day(), dates, F.col("full_date"))
        sales = sales.join(dates.select("full_date", "date_id"), same_day, "left")
        date_id = F.col("date_id")
    same_country = same_key(sales, F.col("CountryID"), geography, F.col("geo_id"))
    sales = sales.join(geography.select("geo_id"), same_country, "left")
    return sales.select(
        F.col("InvoiceNo").alias("invoice_no"),
        date_id.alias("date_id"),
        F.col("CustomerID").alias("customer_id"),
        F.col("StockCode").alias("product_id"),
        F.col("geo_id"),
        F.col("Quantity").alias("quantity"),
        F.col("UnitPrice").alias("unit_price"),
    )


def with_derived(sales: DataFrame) -> DataFrame:
    """``sales`` with ``sale_id`` in front and ``total_price`` behind ``unit_price``; further columns come last."""
    own = ("invoice_no", "date_id", "customer_id", "product_id", "geo_id", "quantity", "unit_price")
    return sales.select(
        F.concat("invoice_no", F.lit("-"), "product_id").alias("sale_id"),
        *own,
        (F.col("quantity") * F.col("unit_price")).alias("total_price"),
        *(name for name in sales.columns if name not in own),
    )


def unpriced_sales(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions that the fact leaves out for want of a price."""
    prices = _daily_prices(products)
    return transactions.join(prices, _same_product_and_day(transactions, prices), "left_anti")


def repeated_sale_ids(fact: DataFrame) -> DataFrame:
    """``sale_id`` values that label more than one row, with their number of rows."""
    counts = fact.groupBy("sale_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter("row_count > 1")


def product_uniqueness(products_dimension: DataFrame) -> DataFrame:
    """One row: how many products there are, and how many have more than one description.

    The sales of the latter count once per description in the report by product.
    """
    descriptions = products_dimension.groupBy("product_id").agg(F.count(F.lit(1)).alias("description_count"))
    return descriptions.agg(
        F.count(F.lit(1)).alias("product_count"),
        F.count_if(F.col("description_count") > 1).alias("ambiguous_count"),
    )
