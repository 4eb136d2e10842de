"""Loads that compute changed months only: always equal to a full rebuild, and to no more work than that."""

import re
from collections import Counter

import pytest
from retail_rows import prices

from tillmark import cli, schemas, versions
from tillmark.plans import daily, incremental
from tillmark.plans.daily import DailyRun
from tillmark.plans.warehouse import star_schema
from tillmark.sources.layers import read_layer, read_valid_transactions

HEADER = "StockCode,ProductDescription,UnitPrice,Date\n"
COUNTRIES = {"1101": "United Kingdom", "1102": "France"}
TABLES = ("dim_date", "dim_customers", "dim_products", "dim_geography", "fct_sales")


class Shop:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        (folder / "raw").mkdir()
        self.prices = {("A", day): "1.50" for day in ("2024-01-05", "2024-02-05", "2024-03-05")}
        self.countries = dict(COUNTRIES)
        self.run = DailyRun(*(str(folder / name) for name in ("raw", "countries.csv", "products.csv", "lake")))
        self.deliveries = 0

    def deliver(self, *invoices):
        text = "".join(f"{number},A,2,{day} 10:00,{customer},{country}-1\n" for number, day, customer, country in invoices)
        (self.folder / "raw" / f"{self.deliveries}.txt").write_text(text)
        self.deliveries += 1

    def load(self, ingest=True):
        rows = "".join(f"{code},CAKE,{price},{day}\n" for (code, day), price in self.prices.items())
        (self.folder / "products.csv").write_text(HEADER + rows)
        listed = "".join(f"{code},{name}\n" for code, name in self.countries.items())
        (self.folder / "countries.csv").write_text("CountryID,CountryName\n" + listed)
        daily.refresh_dimensions(self.spark, self.run)
        if ingest:
            daily.ingest_transactions(self.spark, self.run)
        return daily.refresh_gold(self.spark, self.run)

    def stored(self):
        return {name: Counter(map(tuple, read_layer(self.spark, name, self.run.gold).collect())) for name in TABLES}

    def rebuilt(self):
        lake = self.run.lake
        star = star_schema(
            read_valid_transactions(self.spark, self.run.transactions),
            read_layer(self.spark, "products", lake),
            read_layer(self.spark, "countries", lake),
        )
        return {name: Counter(map(tuple, df.collect())) for name, df in star.items()}

    def parts(self):
        months = versions.latest(self.spark, f"{self.run.gold}/fct_sales").content["months"]
        return {month: one["part"] for month, one in months.items()}


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_loads_equal_a_rebuild(shop, monkeypatch):
    shop.deliver((1, "05/01/2024", 7, "1101"), (2, "05/02/2024", 8, "1102"), (3, "bad", 9, "1101"), (4, "05/02/2024", 5, "9999"))
    counts = shop.load()
    assert shop.stored() == shop.rebuilt()
    assert counts == {name: sum(rows.values()) for name, rows in shop.stored().items()}
    first = shop.parts()
    assert set(first) == {"202401", "202402"}

    # Nothing new: nothing is read or written.
    monkeypatch.setattr(incremental, "fact_of_months", lambda *_: 1 / 0)
    assert shop.load() == counts and shop.parts() == first
    monkeypatch.undo()

    # A late invoice of January, and a sale without a price.
    shop.deliver((5, "05/01/2024", 10, "1101"), (6, "06/03/2024", 11, "1101"))
    shop.load()
    assert shop.stored() == shop.rebuilt()
    second = shop.parts()
    assert second["202402"] == first["202402"] and second["202401"] != first["202401"]

    # A price that changed, one that came and one that is listed twice as often.
    shop.prices["A", "2024-02-05"] = "1.75"
    shop.prices["A", "2024-03-06"] = "2.00"
    shop.load()
    assert shop.stored() == shop.rebuilt()
    third = shop.parts()
    assert third["202401"] == second["202401"] and third["202402"] != second["202402"] and "202403" in third

    # A price that went, so that a month has no sales left.
    del shop.prices["A", "2024-03-06"]
    shop.load()
    assert shop.stored() == shop.rebuilt() and set(shop.parts()) == {"202401", "202402"}

    # A country that went: its months get another key, the others stay.
    del shop.countries["1102"]
    shop.load()
    assert shop.stored() == shop.rebuilt()
    assert shop.parts()["202401"] == second["202401"] and shop.parts()["202402"] != third["202402"]

    # Replayed: its sales go, with a customer and a day that only they had.
    assert daily.replay_quarantine(shop.spark, shop.run) == {"moved_to_valid": 0, "moved_to_quarantine": 1}
    shop.load(ingest=False)
    assert shop.stored() == shop.rebuilt() and set(shop.parts()) == {"202401"}

    # And one that came.
    shop.countries |= {"9999": "New Country", "1102": "France"}
    shop.load(ingest=False)
    assert daily.replay_quarantine(shop.spark, shop.run) == {"moved_to_valid": 2, "moved_to_quarantine": 0}
    shop.load(ingest=False)
    assert shop.stored() == shop.rebuilt() and set(shop.parts()) == {"202401", "202402"}


def test_a_load_that_dies_is_done_again(shop, monkeypatch):
    shop.deliver((1, "05/01/2024", 7, "1101"))
    shop.load()
    before = shop.stored()["fct_sales"]
    shop.deliver((2, "05/01/2024", 8, "1101"), (3, "05/02/2024", 8, "1102"))
    daily.ingest_transactions(shop.spark, shop.run)
    commit = versions.commit

    def dies(spark, path, *arguments):
        return 1 / 0 if path.endswith("fct_sales") else commit(spark, path, *arguments)

    monkeypatch.setattr(versions, "commit", dies)
    with pytest.raises(ZeroDivisionError):
        daily.refresh_gold(shop.spark, shop.run)
    monkeypatch.undo()
    assert shop.stored()["fct_sales"] == before
    shop.load()
    assert shop.stored() == shop.rebuilt()


def test_prices_cleared_away_mean_a_rebuild(shop):
    shop.deliver((1, "05/01/2024", 7, "1101"), (2, "05/02/2024", 7, "1101"))
    shop.load()
    before = shop.parts()
    shop.prices["A", "2024-02-05"] = "9.00"
    for _ in range(2):
        daily.refresh_dimensions(shop.spark, shop.run)
    versions.tidy(shop.spark, f"{shop.run.lake}/products", keep=1, seconds=0)
    shop.load()
    assert shop.stored() == shop.rebuilt() and not set(before.values()) & set(shop.parts().values())


def test_only_the_months_are_read(shop):
    shop.deliver((1, "05/01/2024", 7, "1101"), (2, "05/02/2024", 8, "1102"))
    shop.load()
    sources = incremental.Sources.latest(shop.spark, shop.run.lake)
    plan = sources.transactions({"202401"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "invoice_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # Files read by the scan itself, as the partition filters leave them.
    read = sources.transactions({"202401"}).selectExpr("input_file_name() AS name").distinct().collect()
    assert len(read) == 1 and "invoice_month=202401" in read[0].name
    prices = sources.prices({"202401"})._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2024-01-01)" in prices and "LessThanOrEqual(Date,2024-01-31)" in prices


def test_first_load_without_transactions(shop):
    (shop.folder / "raw" / "0.txt").write_text("")
    assert shop.load()["fct_sales"] == 0
    assert shop.stored() == shop.rebuilt()


def test_replay_command(shop, capsys):
    shop.deliver((1, "05/01/2024", 7, "1101"), (2, "05/02/2024", 8, "9999"))
    shop.load()
    shop.countries["9999"] = "New Country"
    shop.load(ingest=False)
    assert cli.main(["replay", "--lake", shop.run.lake]) == {"moved_to_valid": 1, "moved_to_quarantine": 0}
    assert cli.main(["replay", "--lake", shop.run.lake]) == {"moved_to_valid": 0, "moved_to_quarantine": 0}


def test_prices_are_compared_without_moving_them(spark, monkeypatch, capsys):
    """One row per month and task is shuffled, and months differ by any price that came, went, changed or is there twice."""
    days = ("2024-01-05", "2024-02-05", "2024-03-05", "2024-04-05", "2024-05-05")
    old = [("A", "CAKE", "1.50", day) for day in days] + [("A", "CAKE", None, days[0]), ("A", "CAKE", "9.00", None)]
    new = [*old, ("A", "CAKE", "1.50", days[1]), ("B", "CAKE", "1.50", "2024-06-05")]
    new[2:4] = [("A", "CAKE", "1.60", days[2])]
    kind, plans = type(spark.range(0)), []
    collect = kind.collect

    def seen(self):
        rows = collect(self)
        self.explain()
        plans.append(capsys.readouterr().out)
        return rows

    monkeypatch.setattr(kind, "collect", seen)
    assert incremental.price_months(prices(spark, old), prices(spark, new)) == {"202402", "202403", "202404", "202406"}
    assert incremental.price_months(prices(spark, old), prices(spark, old[::-1])) == set()
    shuffled = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", "".join(plans))
    assert shuffled and not [keys for keys in shuffled if "StockCode" in keys]


def test_the_facts_shuffle_carries_no_derived_column(shop, monkeypatch):
    carried, write = [], incremental.write_layer

    def writing(df, *args, **kwargs):
        if kwargs.get("partition_by"):
            carried.append(df.columns)
        write(df, *args, **kwargs)

    monkeypatch.setattr(incremental, "write_layer", writing)
    shop.deliver((1, "05/01/2024", 7, "1101"), (2, "05/02/2024", 8, "1102"))
    shop.load()
    assert carried and not [columns for columns in carried if {"sale_id", "total_price"} & set(columns)]
    assert shop.stored() == shop.rebuilt()
    assert read_layer(shop.spark, "fct_sales", shop.run.gold).schema == schemas.FCT_SALES
