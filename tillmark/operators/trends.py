"""Products ranked by how many messages mention them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.functions.keywords import PRODUCT_KEYWORDS, product_mention
from tillmark.functions.parsing import message_text

# Fixed value: how many products the trend table lists.
TOP = 10


def mentions(messages: DataFrame, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS) -> DataFrame:
    """One row per message that mentions a product: its text and the product."""
    return messages.select(message_text(F.col("value")).alias("text")).select(
        "text", product_mention(F.col("text"), keywords).alias("product_mention")
    ).filter(F.col("product_mention").isNotNull())


def mention_counts(messages: DataFrame, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS) -> DataFrame:
    """Messages per product; also runs on a stream, where the state is one row per product."""
    return mentions(messages, keywords).groupBy("product_mention").count()


def top_mentions(counts: DataFrame, n: int = TOP) -> DataFrame:
    """The most mentioned products; equal counts are ordered by name."""
    return counts.orderBy(F.col("count").desc(), F.col("product_mention").asc()).limit(n)


def trending_products(
    messages: DataFrame, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS, n: int = TOP
) -> DataFrame:
    return top_mentions(mention_counts(messages, keywords), n)
