"""Which product a text mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords and the product each stands for. A later entry wins over an earlier one.
PRODUCT_KEYWORDS = (
    ("cake", "SET OF 3 CAKE TINS PANTRY DESIGN"),
    ("glass star", "GLASS STAR FROSTED T-LIGHT HOLDER"),
    ("union jack", "HAND WARMER UNION JACK"),
    ("bird ornament", "ASSORTED COLOUR BIRD ORNAMENT"),
    ("playhouse", "POPPY'S PLAYHOUSE BEDROOM"),
    ("mug cosy", "IVORY KNITTED MUG COSY"),
)


def product_mention(text: Column, keywords: Sequence[tuple[str, str]] = PRODUCT_KEYWORDS) -> Column:
    """The product of the last-listed keyword that ``text`` contains, ignoring case; NULL if it contains none.

    Keywords match inside words too ("pancakes" mentions "cake").
    """
    lowered = F.lower(text)
    hits = [F.when(lowered.contains(keyword), F.lit(product)) for keyword, product in reversed(keywords)]
    return F.coalesce(*hits, F.lit(None).cast("string"))
