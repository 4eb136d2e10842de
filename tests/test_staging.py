"""Inputs that queries make for the jobs they run: each is derived from the tables and written once."""

import pytest
from pyspark.sql import functions as F

from tillmark.plans import registry
from tillmark.session import scratch_path
from tillmark.sources import files
from tillmark.sources.star_tables import StarTables

FOLDER = "/root/testdata/sf0.001"


def test_deliveries_are_written_once(spark):
    data = registry._Data(spark, FOLDER)
    path = scratch_path(spark, "staging")
    folders = list(registry._drops(data, path))
    raw = StarTables(spark, FOLDER).raw_transactions()
    written = spark.read.option("recursiveFileLookup", True).schema(raw.schema).csv(path)
    assert written.count() == raw.count()
    sizes = [files.read_transactions(spark, folder).count() for folder in folders]
    assert len(sizes) == registry.DROPS and 0 < sizes[0] < sizes[1] < sizes[2]
    assert files.read_transactions(spark, folders[-1]).exceptAll(raw).isEmpty()


def test_corrected_prices_are_derived_once(spark, monkeypatch):
    calls, raw_products, folders, states = [], StarTables.raw_products, [], []

    def derived(self):
        calls.append(raw_products(self))
        return calls[-1]

    def refreshed(session, run):
        folders.append(run.raw_products)
        states.append(files.read_products(session, run.raw_products))

    monkeypatch.setattr(StarTables, "raw_products", derived)
    monkeypatch.setattr(registry.daily, "refresh_dimensions", refreshed)
    monkeypatch.setattr(registry.daily, "ingest_transactions", lambda *_: None)
    monkeypatch.setattr(registry.daily, "refresh_gold", lambda *_: None)
    monkeypatch.setattr(registry, "read_layer", lambda *_: None)
    registry.QUERIES["daily_sales_incremental"](spark, FOLDER)
    right = calls[0].select("StockCode", "ProductDescription", "UnitPrice", "Date")
    corrected = F.pmod(F.xxhash64("StockCode"), F.lit(3)) == 0
    wrong = right.withColumn("UnitPrice", F.when(corrected, F.lit("0.01")).otherwise(F.col("UnitPrice")))
    for expected, state in ((wrong, states[0]), (wrong, states[1]), (right, states[2])):
        assert expected.exceptAll(state).isEmpty() and state.exceptAll(expected).isEmpty()
    # Of every price that is never corrected one row is written.
    root = folders[0].rpartition("/")[0]
    written = spark.read.option("recursiveFileLookup", True).option("header", True).csv(root)
    assert len(calls) == 1 and written.count() == right.count() + right.filter(corrected).count()


@pytest.mark.parametrize("name, function", [("kept_metrics", "load_measured"), ("dashboard_trends", "star_schema")])
def test_raw_inputs_are_not_derived_again(spark, monkeypatch, name, function):
    """What is written several times, or goes into several tables, comes from stored bronze."""
    build, given = getattr(registry, function), []

    def called(*args):
        frames = args[0].values() if function == "load_measured" else args
        given.extend(path for df in frames for path in df.inputFiles())
        return build(*args)

    monkeypatch.setattr(registry, function, called)
    registry.QUERIES[name](spark, FOLDER).collect()
    assert given and not [path for path in given if "lineitem" in path or "orders" in path]
