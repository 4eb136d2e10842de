"""Every registered query against its SQL, on the generated tables."""

import os

import pytest
from comparing import connect, oracle_bag, spark_bag
from pyspark.sql import functions as F

from tillmark.plans.oracle import ORACLE
from tillmark.plans.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    assert spark_bag(QUERIES[name](spark, FOLDER)) == oracle_bag(connection, ORACLE[name])


@pytest.mark.skipif(not FOLDER.endswith("sf0.01"), reason="figures of sf0.01")
def test_known_figures(spark):
    """Figures stated in FIXTURES.md."""

    def first(name, *columns):
        return tuple(QUERIES[name](spark, FOLDER).agg(*columns).first())

    count = F.count(F.lit(1))
    present = [F.count(name) for name in ("Quantity", "InvoiceTimestamp", "RegionID")]
    assert first("transactions_parsed", count, *present) == (60000, 58534, 58817, 57505)
    assert first("countries_bronze", count) == (25,)
    assert first("products_bronze", count, F.count("Date"), F.count("UnitPrice")) == (59562, 56553, 57602)
    assert first("transactions_quarantine", count, F.sum("Quantity")) == (5138, 131236)
    rows, total = first("fct_sales", count, F.sum("total_price"))
    assert (rows, str(total)) == (50990, "1154101816.50")
    assert first("dim_date", count, F.min("date_id"), F.max("date_id")) == (2398, 19950101, 20010801)
    assert first("quantity_outliers", count, F.sum("median_quantity"), F.sum("Quantity")) == (446, 7986, 21235)
    top = [row.customer_id for row in QUERIES["top_customers"](spark, FOLDER).collect()]
    assert top == ["1378", "565", "532", "952", "540"]
    mentions = [tuple(row) for row in QUERIES["trending_products"](spark, FOLDER).collect()]
    assert mentions == [("widget", 261), ("ring", 248), ("gizmo", 242), ("red", 161)]
