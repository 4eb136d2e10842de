import datetime as dt
from decimal import Decimal

import pytest
from retail_rows import countries, prices, transactions

from tillmark import schemas
from tillmark.operators import dimensions, fact

SALES = [
    ("1", "A", 2, "01/02/2024 10:00", "17850", "1101-1"),
    ("1", "A", 3, "01/02/2024 23:59", "17850", "1101-1"),
    ("2", "B", 4, "02/02/2024 00:00", "x7", "1102-1"),
    ("3", "A", 5, "03/02/2024 10:00", "17850", "1101-1"),
    ("4", "A", 6, "bad date", "17850", "1101-1"),
    ("5", "B", None, "02/02/2024 10:00", None, "9999-1"),
    ("6", None, 1, "02/02/2024 10:00", "17850", "1101-1"),
]
PRICES = [
    ("A", "CAKE", "1.50", "2024-02-01"),
    ("B", "STAR", "2.00", "2024-02-02"),
    ("B", "STAR", None, "2024-02-01"),
    ("C", "JACK", "9.99", "2024-02-03"),
]
COUNTRIES = [("1101", "United Kingdom"), ("1102", "France")]


@pytest.fixture
def bronze_frames(spark):
    return transactions(spark, SALES), prices(spark, PRICES), countries(spark, COUNTRIES)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dim_date(bronze_frames):
    dates = dimensions.dim_date(bronze_frames[0])
    assert dates.schema == schemas.DIM_DATE
    assert rows(dates) == rows_of(
        (dt.date(2024, 2, 1), 20240201, 2024, 2, 1),
        (dt.date(2024, 2, 2), 20240202, 2024, 2, 2),
        (dt.date(2024, 2, 3), 20240203, 2024, 2, 3),
        (None, None, None, None, None),
    )


def rows_of(*expected):
    return sorted(expected, key=repr)


def test_dim_customers(bronze_frames):
    customers = dimensions.dim_customers(bronze_frames[0])
    assert customers.schema == schemas.DIM_CUSTOMERS
    assert rows(customers) == rows_of(("17850", 17850), ("x7", None), (None, None))


def test_dim_products(spark, bronze_frames):
    products = dimensions.dim_products(bronze_frames[1])
    assert products.schema == schemas.DIM_PRODUCTS
    assert rows(products) == rows_of(("A", "CAKE"), ("B", "STAR"), ("C", "JACK"))
    renamed = prices(spark, [*PRICES, ("A", "CAKE TIN", "2.00", "2024-02-05")])
    uniqueness = fact.product_uniqueness(dimensions.dim_products(renamed))
    assert rows(uniqueness) == [(3, 1)]


def test_dim_geography(bronze_frames):
    geography = dimensions.dim_geography(bronze_frames[2])
    assert geography.columns == schemas.DIM_GEOGRAPHY.names
    assert rows(geography) == rows_of(("1101", "United Kingdom", "Europe"), ("1102", "France", "Europe"))


@pytest.mark.parametrize("lookup", [False, True])
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_fact(bronze_frames, setting, lookup, threshold):
    setting(spark__sql__autoBroadcastJoinThreshold=threshold)
    sales, products, nations = bronze_frames
    dates = dimensions.dim_date(sales) if lookup else None
    priced = fact.fct_sales(sales, products, dimensions.dim_geography(nations), dates)
    assert priced.dtypes == [(field.name, field.dataType.simpleString()) for field in schemas.FCT_SALES]
    assert rows(priced) == rows_of(
        ("1-A", "1", 20240201, "17850", "A", "1101", 2, Decimal("1.50"), Decimal("3.00")),
        ("1-A", "1", 20240201, "17850", "A", "1101", 3, Decimal("1.50"), Decimal("4.50")),
        ("2-B", "2", 20240202, "x7", "B", "1102", 4, Decimal("2.00"), Decimal("8.00")),
        ("5-B", "5", 20240202, None, "B", None, None, Decimal("2.00"), None),
    )


def test_unpriced_sales(bronze_frames):
    sales, products, _ = bronze_frames
    assert rows(fact.unpriced_sales(sales, products).select("InvoiceNo")) == [("3",), ("4",), ("6",)]


def test_day_priced_twice_yields_two_rows(spark, bronze_frames):
    twice = prices(spark, [*PRICES, ("B", "STAR", "3.00", "2024-02-02")])
    priced = fact.fct_sales(bronze_frames[0], twice, dimensions.dim_geography(bronze_frames[2]))
    assert priced.filter("sale_id = '2-B'").count() == 2


def test_repeated_sale_ids(bronze_frames):
    sales, products, nations = bronze_frames
    priced = fact.fct_sales(sales, products, dimensions.dim_geography(nations))
    assert rows(fact.repeated_sale_ids(priced)) == [("1-A", 2)]


def test_empty_inputs(bronze_frames):
    sales, products, nations = (df.limit(0) for df in bronze_frames)
    priced = fact.fct_sales(sales, products, dimensions.dim_geography(nations))
    assert (priced.columns, priced.count()) == (schemas.FCT_SALES.names, 0)
    assert dimensions.dim_date(sales).isEmpty()
