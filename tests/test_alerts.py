from tillmark.operators import alerts

OUTLIERS = "CustomerID string, InvoiceNo string, StockCode string, Quantity int, median_quantity int"
INVALID = "InvoiceNo string, StockCode string, Quantity int, CustomerID string, CountryID string"


def frames(spark, some):
    outliers = spark.createDataFrame([("17850", "1", "A", 900, 5)], OUTLIERS)
    invalid = spark.createDataFrame([("2", "B", 3, "13047", "9999"), ("3", "C", None, None, None)], INVALID)
    return (outliers, invalid) if some else (outliers.limit(0), invalid.limit(0))


def test_digest(spark):
    assert [tuple(row) for row in alerts.alert_digest(*frames(spark, True)).collect()] == [
        ("High-Value Orders", 1, "1 rows detected."),
        ("Invalid CountryID Transactions", 2, "2 rows detected."),
    ]


def test_digest_of_nothing(spark):
    expected = [
        ("High-Value Orders", "No high-value order anomalies detected."),
        ("Invalid CountryID Transactions", "No invalid CountryID transactions detected."),
    ]
    nothing = frames(spark, False)
    assert [(row.alert, row.row_count, row.message) for row in alerts.alert_digest(*nothing).collect()] == [
        (alert, 0, message) for alert, message in expected
    ]
    assert [tuple(row) for row in alerts.alert_lines(*nothing).collect()] == expected


def test_lines(spark):
    assert {tuple(row) for row in alerts.alert_lines(*frames(spark, True)).collect()} == {
        ("High-Value Orders", "User: 17850, Invoice: 1, Product: A, Quantity: 900, Median: 5"),
        ("Invalid CountryID Transactions", "2,B,3,13047,9999"),
        ("Invalid CountryID Transactions", "3,C,,,"),
    }
