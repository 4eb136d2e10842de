"""What is counted of a bronze table while it is written: rows, and rows with text that nothing could be read from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MISSING = {
    "transactions": {
        "unreadable_dates": "InvoiceTimestamp",
        "unreadable_quantities": "Quantity",
        "missing_products": "StockCode",
        "missing_customers": "CustomerID",
        "missing_countries": "CountryID",
    },
    "products": {"unreadable_prices": "UnitPrice", "unreadable_dates": "Date", "missing_products": "StockCode"},
    "countries": {"missing_countries": "CountryID", "unknown_continents": "ContinentID"},
}


def flaws(table: str) -> dict[str, Column]:
    """Conditions of the flaws of a bronze table by name; none for other tables."""
    return {name: F.col(column).isNull() for name, column in _MISSING.get(table, {}).items()}


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """table_name, metric and value as the last run that measured a table has left them, of ``metrics`` (run, table_name,
    metric, value)."""
    last = metrics.groupBy("table_name").agg(F.max("run").alias("last_run")).withColumnRenamed("table_name", "of")
    joined = metrics.join(last, (metrics["table_name"] == last["of"]) & (metrics["run"] == last["last_run"]))
    return joined.select("table_name", "metric", "value")


def broken_limits(metrics: DataFrame, limits: dict[tuple[str, str], float]) -> DataFrame:
    """Metrics of each table's last run that are more than ``limits[table, metric]`` of its rows: table_name, metric,
    value, row_count and most (the rows that the limit allows).

    A limit of 0 is broken by any row; a table without rows, or that no run has measured, breaks none.
    """
    spark = metrics.sparkSession
    listed = [(table, metric, float(most)) for (table, metric), most in limits.items()]
    allowed = spark.createDataFrame(listed, "limited_table string, limited_metric string, share double")
    latest = latest_metrics(metrics)
    rows = latest.where("metric = 'row_count'").select(F.col("table_name").alias("counted"), F.col("value").alias("row_count"))
    found = latest.join(
        allowed, (latest["table_name"] == allowed["limited_table"]) & (latest["metric"] == allowed["limited_metric"])
    ).join(rows, latest["table_name"] == rows["counted"])
    most = F.floor(F.col("share") * F.col("row_count")).alias("most")
    return found.select("table_name", "metric", "value", "row_count", most).where("value > most")
