"""The sales questions asked of the star schema.

Each sums the fact by its own key first, so the shuffle carries one row per key and task and no key is hot. Only the
sums are joined to a dimension and, where several keys share a label, summed again. The joins are outer so that sales
without a dimension row still count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.schemas import SALES_TOTAL

TOTAL = "total_sales"

# Fixed value: how many products and customers the reports list.
TOP = 5


def _sum(amount: str) -> Column:
    return F.sum(amount).cast(SALES_TOTAL).alias(TOTAL)


def _sales_by_label(fact: DataFrame, dimension: DataFrame, key: str, label: str) -> DataFrame:
    by_key = fact.groupBy(F.col(key).alias("fact_key")).agg(_sum("total_price"))
    labels = dimension.select(key, label)
    return by_key.join(labels, F.col("fact_key") == F.col(key), "left").groupBy(label).agg(_sum(TOTAL))


def _top(sales: DataFrame, label: str, n: int) -> DataFrame:
    return sales.orderBy(F.col(TOTAL).desc_nulls_last(), F.col(label).asc_nulls_last()).limit(n)


def sales_by_day(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return _sales_by_label(fact, dates, "date_id", "full_date")


def sales_by_product(fact: DataFrame, products: DataFrame) -> DataFrame:
    """Sales by description: products that share one are merged."""
    return _sales_by_label(fact, products, "product_id", "description")


def sales_by_country(fact: DataFrame, geography: DataFrame) -> DataFrame:
    return _sales_by_label(fact, geography, "geo_id", "country")


def sales_by_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(_sum("total_price"))


def top_products(fact: DataFrame, products: DataFrame, n: int = TOP) -> DataFrame:
    """The best-selling descriptions; equal sales are ordered by description."""
    return _top(sales_by_product(fact, products), "description", n)


def top_customers(fact: DataFrame, n: int = TOP) -> DataFrame:
    """The best customers; equal sales are ordered by customer."""
    return _top(sales_by_customer(fact), "customer_id", n)
