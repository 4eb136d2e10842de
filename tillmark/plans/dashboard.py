"""The dashboard over the stored star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillmark.operators import sales
from tillmark.plans.trending import TABLE as TRENDS
from tillmark.sources.layers import exists, read_layer

Read = Callable[[str], DataFrame]
Has = Callable[[str], bool]


def dashboard(
    spark: SparkSession, gold: str | None = None, read: Read | None = None, has: Has | None = None
) -> dict[str, DataFrame]:
    """The five questions by name: four over the star schema, and the stored trend table once there is one.

    Tables are Parquet under ``gold`` or catalog tables; ``read(name)`` opens them elsewhere, such as in a database,
    and ``has(name)`` tells whether a table is there.
    Each answer is whole and in order.
    """
    read = read or (lambda name: read_layer(spark, name, gold))
    fact = read("fct_sales")
    answers = {
        "sales_by_day": sales.sales_by_day(fact, read("dim_date")).orderBy("full_date"),
        "top_products": sales.top_products(fact, read("dim_products")),
        "sales_by_country": sales.sales_by_country(fact, read("dim_geography")).orderBy("country"),
        "top_customers": sales.top_customers(fact),
    }
    if has(TRENDS) if has else exists(lambda: read(TRENDS)):
        trends = read(TRENDS)
        answers[TRENDS] = trends.orderBy(trends["count"].desc(), "product_mention")
    return answers
