"""Unusual quantities, against the median and standard deviation of each product.

Both statistics come from how often each quantity occurs per product. That histogram is built with map-side
aggregation, so a product holding a third of all sales reaches its reducer as one row per distinct quantity and task,
and the median is exact whatever the number of sales. Only histogram rows, never sales, are sorted per product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.operators.joins import same_key

# Fixed value: an outlier lies more than this many standard deviations above the median.
OUTLIER_DEVIATIONS = 2


def _weights(df: DataFrame, key: str, value: str) -> DataFrame:
    """``group_key``, ``level`` (a value) and ``weight``: how often; NULL is a level of weight 0."""
    # Names of its own, so that no column of the caller's is meant by mistake.
    own = df.select(F.col(key).alias("group_key"), F.col(value).alias("level"))
    return own.groupBy("group_key", "level").agg(F.count("level").alias("weight"))


def _histogram_weights(histogram: DataFrame) -> DataFrame:
    weight = F.when(F.col("level").isNull(), F.lit(0)).otherwise(F.col("row_count"))
    return histogram.select("group_key", "level", weight.alias("weight"))


def merged_histogram(parts: DataFrame) -> DataFrame:
    """``group_key``, ``level`` and ``row_count`` of all rows, from histograms of parts of them; negative counts take
    rows out."""
    merged = parts.groupBy("group_key", "level").agg(F.sum("row_count").alias("row_count"))
    return merged.filter("row_count <> 0")


def _quantity_levels(weights: DataFrame) -> DataFrame:
    """``group_key``, ``level``, ``median_quantity``, ``stddev_quantity``: one row per key and value.

    The median is the lower of the two middle values of an even group and keeps the type of the values. NULL values
    count for neither; the deviation of a single value is NULL. Counts are multiplied as doubles because count times
    quantity may leave the range of a bigint.

    The levels of one key are sorted in one task: as many as it has distinct values. That suits order quantities; a
    measure with ever new values would be rounded first.
    """
    group = Window.partitionBy("group_key")
    so_far = group.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    level, weight, number = F.col("level"), F.col("weight"), F.col("number")
    levels = weights.withColumns(
        {
            "rank": F.sum(weight).over(so_far),
            "number": F.sum(weight).over(group),
            "total": F.sum(weight.cast("double") * level).over(group),
        }
    )
    deviation = level - F.col("total") / number
    reaches_half = F.col("rank") * 2 >= number
    levels = levels.withColumns(
        {
            "median": F.min(F.when(reaches_half, level)).over(group),
            "squares": F.sum(weight * deviation * deviation).over(group),
        }
    )
    return levels.select(
        "group_key",
        "level",
        F.col("median").alias("median_quantity"),
        F.when(number > 1, F.sqrt(F.col("squares") / (number - 1))).alias("stddev_quantity"),
    )


def group_statistics(df: DataFrame, key: str = "StockCode", value: str = "Quantity") -> DataFrame:
    """``key``, ``median_quantity`` and ``stddev_quantity``: one row per key, the NULL key included."""
    return _statistics(_weights(df, key, value), key)


def histogram_statistics(histogram: DataFrame, key: str = "StockCode") -> DataFrame:
    """The same from a histogram that is at hand; see ``merged_histogram``."""
    return _statistics(_histogram_weights(histogram), key)


def _statistics(weights: DataFrame, key: str) -> DataFrame:
    levels = _quantity_levels(weights)
    return levels.select(F.col("group_key").alias(key), "median_quantity", "stddev_quantity").distinct()


def quantity_outliers(
    df: DataFrame,
    key: str = "StockCode",
    value: str = "Quantity",
    k: float = OUTLIER_DEVIATIONS,
    histogram: DataFrame | None = None,
) -> DataFrame:
    """Distinct order lines whose quantity is above its product's median plus ``k`` standard deviations.

    ``histogram`` is that of ``df`` where it is at hand, which saves a pass over the sales.

    The histogram tells which products have an outlier at all, so sales are joined to the limits of those products
    only: one row per such product, usually small enough for Spark to broadcast. Where it is not, the sales are
    shuffled by product and Spark splits the partition of a hot product, which joins to a single limit.
    """
    limit = F.col("median_quantity") + F.lit(k) * F.col("stddev_quantity")
    limits = (
        _quantity_levels(_weights(df, key, value) if histogram is None else _histogram_weights(histogram))
        .withColumn("limit", limit)
        .filter(F.col("level") > F.col("limit"))
        .select("group_key", "median_quantity", "limit")
        .distinct()
    )
    # Sales under names of their own as well; the caller's come back in the result.
    sales = df.select(
        F.col("CustomerID").alias("customer"),
        F.col("InvoiceNo").alias("invoice"),
        F.col(key).alias("sold_key"),
        F.col(value).alias("sold_value"),
    )
    beyond = same_key(sales, F.col("sold_key"), limits, F.col("group_key")) & (F.col("sold_value") > F.col("limit"))
    found = sales.join(limits, beyond).select("customer", "invoice", "sold_key", "sold_value", "median_quantity")
    return found.distinct().toDF("CustomerID", "InvoiceNo", key, value, "median_quantity")
