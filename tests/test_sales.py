import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark import schemas
from tillmark.operators import sales

CODES = [("A", "CAKE"), ("B", "CAKE"), ("C", "STAR"), ("C", "STAR OLD"), ("D", "JACK")]


@pytest.fixture(scope="module")
def star(spark):
    chance = random.Random(5)
    rows = []
    for i in range(400):
        code = chance.choice(["A", "A", "A", "B", "C", "D", "E"])
        quantity, price = chance.randint(1, 9), Decimal(chance.randint(100, 5000)) / 100
        date = 20240100 + chance.randint(1, 5)
        geo = chance.choice(["1101", "1102", None])
        customer = chance.choice(["1", "2", "3", "4", "5", "6", "7", None])
        rows.append((f"{i}-{code}", str(i), date, customer, code, geo, quantity, price, quantity * price))
    dates = [(dt.date(2024, 1, day), 20240100 + day, 2024, 1, day) for day in range(1, 5)] + [(None,) * 5]
    return rows, {
        "fct_sales": spark.createDataFrame(rows, schemas.FCT_SALES),
        "dim_date": spark.createDataFrame(dates, schemas.DIM_DATE),
        "dim_products": spark.createDataFrame(CODES, schemas.DIM_PRODUCTS),
        "dim_geography": spark.createDataFrame(
            [("1101", "United Kingdom", "Europe"), ("1102", "France", "Europe")], schemas.DIM_GEOGRAPHY
        ),
    }


def totals(rows, labels):
    result = {}
    for row in rows:
        for label in labels(row):
            result[label] = result.get(label, Decimal(0)) + row[8]
    return result


def collected(df):
    return {row[0]: row[1] for row in df.collect()}


def test_by_day(star):
    rows, tables = star
    found = sales.sales_by_day(tables["fct_sales"], tables["dim_date"])
    assert found.dtypes == [("full_date", "date"), ("total_sales", "decimal(31,2)")]
    # The fifth has no row in the dimension and counts under NULL.
    expected = totals(rows, lambda r: [dt.date(2024, 1, r[2] % 100) if r[2] % 100 < 5 else None])
    assert collected(found) == expected


def test_by_product_merges_and_fans_out(star):
    rows, tables = star
    names = {}
    for code, name in CODES:
        names.setdefault(code, []).append(name)
    expected = totals(rows, lambda r: names.get(r[4], [None]))
    assert collected(sales.sales_by_product(tables["fct_sales"], tables["dim_products"])) == expected
    ranked = sorted(expected.items(), key=lambda item: (-item[1], item[0] is None, item[0]))[:5]
    top = sales.top_products(tables["fct_sales"], tables["dim_products"]).collect()
    assert [tuple(row) for row in top] == ranked


def test_by_country(star):
    rows, tables = star
    names = {"1101": "United Kingdom", "1102": "France", None: None}
    expected = totals(rows, lambda r: [names[r[5]]])
    assert collected(sales.sales_by_country(tables["fct_sales"], tables["dim_geography"])) == expected


def test_by_customer(star):
    rows, tables = star
    expected = totals(rows, lambda r: [r[3]])
    assert collected(sales.sales_by_customer(tables["fct_sales"])) == expected
    ranked = sorted(expected.items(), key=lambda item: -item[1])[:3]
    assert [tuple(row) for row in sales.top_customers(tables["fct_sales"], 3).collect()] == ranked


def test_ties_are_ordered_by_label(spark):
    rows = [(None, None, None, customer, None, None, 1, None, Decimal("5.00")) for customer in ["b", None, "c", "a"]]
    top = sales.top_customers(spark.createDataFrame(rows, schemas.FCT_SALES)).collect()
    assert [row.customer_id for row in top] == ["a", "b", "c", None]


def test_all_groupings_add_up(star):
    rows, tables = star
    whole = sum(row[8] for row in rows)
    for df in (
        sales.sales_by_day(tables["fct_sales"], tables["dim_date"]),
        sales.sales_by_country(tables["fct_sales"], tables["dim_geography"]),
        sales.sales_by_customer(tables["fct_sales"]),
    ):
        assert df.agg(F.sum("total_sales")).first()[0] == whole
