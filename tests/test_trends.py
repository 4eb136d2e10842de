from tillmark import schemas
from tillmark.operators import trends

CAKE, STAR = "SET OF 3 CAKE TINS PANTRY DESIGN", "GLASS STAR FROSTED T-LIGHT HOLDER"


def log(spark, texts):
    rows = [(None, text and text.encode(), "t", 0, i, None, 0) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, schemas.MESSAGES)


def test_mentions(spark):
    messages = log(spark, ["Nice cake tins", "nothing here", None, "CAKE on a Glass Star"])
    found = trends.mentions(messages)
    assert {tuple(row) for row in found.collect()} == {("Nice cake tins", CAKE), ("CAKE on a Glass Star", STAR)}


def test_trending(spark):
    messages = log(spark, ["cake", "pancakes", "glass star", "cake glass star", "x"])
    top = trends.trending_products(messages)
    assert top.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.TRENDING_PRODUCTS]
    # Equal counts: by name.
    assert [tuple(row) for row in top.collect()] == [(STAR, 2), (CAKE, 2)]
    assert [tuple(row) for row in trends.trending_products(messages, n=1).collect()] == [(STAR, 2)]


def test_more_products_than_listed(spark):
    keywords = [(f"word{i:02d}", f"product {i:02d}") for i in range(15)]
    messages = log(spark, [f"word{i:02d}" for i in range(15) for _ in range(i + 1)])
    top = [tuple(row) for row in trends.trending_products(messages, keywords).collect()]
    assert top == [(f"product {i:02d}", i + 1) for i in range(14, 4, -1)]


def test_empty(spark):
    assert trends.trending_products(log(spark, [])).collect() == []
