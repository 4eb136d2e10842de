import datetime as dt
from decimal import Decimal

import pytest

from tillmark import schemas
from tillmark.operators import bronze
from tillmark.sources import files

def dtypes(schema):
    return [(field.name, field.dataType.simpleString()) for field in schema]


LINES = """\
1,22752,7,01/02/2024 10:00,17850,1101-1
1,22752,abc,01/02/2024 10:00,17850,1101-1

2,22752,3,01/02/2024 10:00,17850
3,22752,4,01/02/2024 10:00,17850,1101-1,extra
4,22752,5,2024-01-02,17850,1101
5,22752,6,01/02/2024 10:00,17850,1101-2-9
"""


def test_transactions_file(spark, tmp_path):
    (tmp_path / "invoice_1.txt").write_text(LINES)
    (tmp_path / "invoice_2.txt").write_text("6,84879,1,02/02/2024 00:05,13047,5501-6\n")
    parsed = bronze.parse_transactions(files.read_transactions(spark, str(tmp_path)))
    assert parsed.schema == schemas.TRANSACTIONS
    got = {(row.InvoiceNo, row.Quantity): tuple(row)[4:] for row in parsed.collect()}
    ten = dt.datetime(2024, 2, 1, 10)
    assert got == {
        ("1", 7): ("17850", "1101-1", ten, "1101", "1"),
        ("1", None): ("17850", "1101-1", ten, "1101", "1"),
        ("2", 3): ("17850", None, ten, None, None),
        ("3", 4): ("17850", "1101-1", ten, "1101", "1"),
        ("4", 5): ("17850", "1101", None, "1101", None),
        ("5", 6): ("17850", "1101-2-9", ten, "1101", "2"),
        ("6", 1): ("13047", "5501-6", dt.datetime(2024, 2, 2, 0, 5), "5501", "6"),
    }


def test_countries_file(spark, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text("CountryID,CountryName\n1101,United Kingdom\n1301,Turkey\nAB12,Nowhere\n9901,\n")
    countries = bronze.countries(files.read_countries(spark, str(path)))
    assert countries.dtypes == dtypes(schemas.COUNTRIES)
    assert sorted(map(tuple, countries.collect())) == [
        ("1101", "United Kingdom", 11, "Europe"),
        ("1301", "Turkey", 13, "Europe/Asia"),
        ("9901", None, 99, "Unknown"),
        ("AB12", "Nowhere", None, "Unknown"),
    ]


@pytest.mark.parametrize("header", ["StockCode,ProductDescription,UnitPrice,Date", "Date,UnitPrice,StockCode,ProductDescription"])
def test_products_file_by_header(spark, tmp_path, header):
    values = {"StockCode": "22752", "ProductDescription": "CAKE TINS", "UnitPrice": "23.455", "Date": "2024-01-31"}
    path = tmp_path / "products.csv"
    path.write_text(header + "\n" + ",".join(values[name] for name in header.split(",")) + "\n")
    products = bronze.products(files.read_products(spark, str(path)))
    assert products.schema == schemas.PRODUCTS
    assert [tuple(row) for row in products.collect()] == [
        ("22752", "CAKE TINS", Decimal("23.46"), dt.date(2024, 1, 31))
    ]


def test_empty_files(spark, tmp_path):
    (tmp_path / "transactions").mkdir()
    (tmp_path / "products.csv").write_text("StockCode,ProductDescription,UnitPrice,Date\n")
    parsed = bronze.parse_transactions(files.read_transactions(spark, str(tmp_path / "transactions")))
    products = bronze.products(files.read_products(spark, str(tmp_path / "products.csv")))
    assert (parsed.schema, parsed.count()) == (schemas.TRANSACTIONS, 0)
    assert (products.schema, products.count()) == (schemas.PRODUCTS, 0)
