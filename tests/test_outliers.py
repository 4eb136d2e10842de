import random
import statistics

import pytest
from pyspark.sql import functions as F

from tillmark.operators.outliers import group_statistics, quantity_outliers

SCHEMA = "InvoiceNo string, StockCode string, Quantity int, CustomerID string"


def frame(spark, groups):
    rows = [
        (str(i), code, quantity, "c") for code, quantities in groups.items() for i, quantity in enumerate(quantities)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def stats(df):
    return {row.StockCode: (row.median_quantity, row.stddev_quantity) for row in group_statistics(df).collect()}


def test_small_groups(spark):
    found = stats(
        frame(spark, {"one": [7], "even": [4, 1, 3, 2], "nulls": [None, None], "some": [None, 5, 9], None: [1, 1, 4]})
    )
    assert found["one"] == (7, None)
    assert found["even"] == (2, pytest.approx(statistics.stdev([1, 2, 3, 4])))
    assert found["nulls"] == (None, None)
    assert found["some"] == (5, pytest.approx(statistics.stdev([5, 9])))
    assert found[None] == (1, pytest.approx(statistics.stdev([1, 1, 4])))


def test_schema(spark):
    df = group_statistics(frame(spark, {"a": [1]}))
    assert df.dtypes == [("StockCode", "string"), ("median_quantity", "int"), ("stddev_quantity", "double")]


def test_constant_group_has_no_deviation(spark):
    big = 2_000_000_000
    df = frame(spark, {"same": [big] * 50})
    assert stats(df) == {"same": (big, 0.0)}
    assert quantity_outliers(df).isEmpty()


@pytest.mark.parametrize("n, flagged", [(3, False), (5, True), (9, True)])
def test_one_large_among_equal_quantities(spark, n, flagged):
    found = quantity_outliers(frame(spark, {"a": [5] * (n - 1) + [5000]})).collect()
    assert [(row.Quantity, row.median_quantity) for row in found] == ([(5000, 5)] if flagged else [])


def test_agrees_with_built_in_functions(spark):
    chance = random.Random(7)
    groups = {
        f"p{i}": [chance.choice([None, *range(-3, 12), 2000 + i]) for _ in range(chance.randint(1, 60))]
        for i in range(40)
    }
    df = frame(spark, groups)
    expected = {
        row[0]: (row[1], row[2])
        for row in df.groupBy("StockCode")
        .agg(F.percentile_approx("Quantity", 0.5), F.stddev_samp("Quantity"))
        .collect()
    }
    found = stats(df)
    assert found.keys() == expected.keys()
    for code, (median, deviation) in expected.items():
        assert found[code] == (median, None if deviation is None else pytest.approx(deviation, rel=1e-12))


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_outliers_against_brute_force(spark, setting, threshold):
    setting(spark__sql__autoBroadcastJoinThreshold=threshold)
    chance = random.Random(11)
    rows = []
    for i in range(1500):
        # One product holds a third of all lines.
        code = "hot" if chance.random() < 0.33 else f"p{chance.randint(0, 20)}"
        quantity = chance.randint(2000, 9999) if chance.random() < 0.05 else chance.randint(1, 10)
        rows.append((str(i % 300), code, quantity, str(i % 7)))
    by_code = {}
    for _, code, quantity, _ in rows:
        by_code.setdefault(code, []).append(quantity)
    limits = {
        code: (statistics.median_low(values), statistics.stdev(values))
        for code, values in by_code.items()
        if len(values) > 1
    }
    expected = {
        (customer, invoice, code, quantity, limits[code][0])
        for invoice, code, quantity, customer in rows
        if code in limits and quantity > limits[code][0] + 2 * limits[code][1]
    }
    found = [tuple(row) for row in quantity_outliers(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected
    assert all(quantity > median for *_, quantity, median in found)


def test_equal_lines_are_reported_once(spark):
    rows = [("1", "a", 5, "c")] * 20 + [("1", "a", 900, "c")] * 2
    found = quantity_outliers(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(row) for row in found] == [("c", "1", "a", 900, 5)]


def test_lower_bound_parameter(spark):
    df = frame(spark, {"a": [1, 2, 3, 4, 5, 6, 7, 8, 9, 20]})
    assert {row.Quantity for row in quantity_outliers(df, k=2).collect()} == {20}
    assert {row.Quantity for row in quantity_outliers(df, k=0.5).collect()} == {8, 9, 20}


def test_empty(spark):
    df = frame(spark, {"a": [1]}).limit(0)
    assert quantity_outliers(df).isEmpty()
    assert group_statistics(df).isEmpty()
