import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark.functions import dates, geography, keywords, parsing, reporting


def evaluate(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, x {dtype}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_invoice_timestamp(spark):
    values = ["01/12/2010 08:26", "31/12/2024 23:59", "2024-01-02", "31/02/2024 10:00", "01/12/2010", "", None]
    expected = [dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2024, 12, 31, 23, 59)] + [None] * 5
    assert evaluate(spark, values, parsing.invoice_timestamp) == expected


@pytest.mark.parametrize(
    "expression, expected",
    [
        (parsing.country_id, ["1101", "1101", "1101", "1101", "", "", None]),
        (parsing.region_id, ["1", None, "2", "", "3", None, None]),
    ],
)
def test_country_parts(spark, expression, expected):
    values = ["1101-1", "1101", "1101-2-9", "1101-", "-3", "", None]
    assert evaluate(spark, values, expression) == expected


def test_whole_number(spark):
    values = ["17850", "17850.0", "12.9", "-3", " 7 ", "x", "1.x", "1e3", "", "99999999999", None]
    expected = [17850, 17850, 12, -3, 7, None, None, None, None, None, None]
    values += ["17850.0 ", "17850. ", " 17850.5\t", "."]
    expected += [17850, 17850, 17850, None]
    assert evaluate(spark, values, parsing.whole_number) == expected


def test_unit_price(spark):
    values = ["12.34", "12.345", "12.344", "-1.005", "x", "123456789.1", "99999999.99", "", None]
    expected = [
        Decimal("12.34"), Decimal("12.35"), Decimal("12.34"), Decimal("-1.01"), None, None, Decimal("99999999.99"),
        None, None,
    ]
    assert evaluate(spark, values, parsing.unit_price) == expected


def test_price_date(spark):
    values = ["2024-01-31", "2024-02-30", "31/01/2024", "", None]
    assert evaluate(spark, values, parsing.price_date) == [dt.date(2024, 1, 31), None, None, None, None]


def test_message_text(spark):
    values = [bytearray("cosy Größe", "utf-8"), bytearray(), None]
    assert evaluate(spark, values, parsing.message_text, "binary") == ["cosy Größe", "", None]


def test_continent_id(spark):
    values = ["1101", "55", "5", "AB12", "", None]
    assert evaluate(spark, values, geography.continent_id) == [11, 55, 5, None, None, None]


def test_continent_name(spark):
    values = [*geography.CONTINENTS, 99, None]
    expected = [*geography.CONTINENTS.values(), "Unknown", "Unknown"]
    assert evaluate(spark, values, geography.continent_name, "int") == expected


def test_date_keys(spark):
    values = [dt.date(2024, 1, 31), dt.date(1995, 12, 1), None]
    assert evaluate(spark, values, dates.date_key, "date") == [20240131, 19951201, None]
    assert evaluate(spark, values, dates.month_key, "date") == [202401, 199512, None]


def test_product_mention(spark):
    cake, star, jack = (product for _, product in keywords.PRODUCT_KEYWORDS[:3])
    cases = {
        "Sample about a nice CAKE tin": cake,
        "Pancakes": cake,
        "a cake glass star": star,
        "glass star, then cake": star,
        "This Union Jack hand warmer is great!": jack,
        "glassstar": None,
        "": None,
        None: None,
    }
    assert evaluate(spark, list(cases), keywords.product_mention) == list(cases.values())


def test_last_keyword_wins_for_every_pair(spark):
    listed = keywords.PRODUCT_KEYWORDS
    pairs = [(a, b) for a in range(len(listed)) for b in range(len(listed))]
    texts = [f"{listed[a][0]} {listed[b][0]}" for a, b in pairs]
    expected = [listed[max(a, b)][1] for a, b in pairs]
    assert evaluate(spark, texts, keywords.product_mention) == expected


def test_no_keywords(spark):
    assert evaluate(spark, ["cake"], lambda c: keywords.product_mention(c, [])) == [None]


def test_outlier_line(spark):
    df = spark.createDataFrame(
        [("17850", "536365", "22752", 5000, 5), (None, "1", "2", 3, 1)],
        "CustomerID string, InvoiceNo string, StockCode string, Quantity int, median_quantity int",
    )
    assert [row[0] for row in df.select(reporting.outlier_line()).collect()] == [
        "User: 17850, Invoice: 536365, Product: 22752, Quantity: 5000, Median: 5",
        "User: null, Invoice: 1, Product: 2, Quantity: 3, Median: 1",
    ]


def test_csv_line(spark):
    df = spark.createDataFrame([("a", 1, None), ('say "x", y', None, "z")], "a string, b int, c string")
    lines = [row[0] for row in df.select(reporting.csv_line("a", "b", "c")).collect()]
    assert lines[0] == "a,1,"
    assert lines[1].endswith(",,z")
