"""The star schema kept up to date: only months that something has changed in are computed anew.

The fact is a table of ``versions`` with a folder per month. Its version also says which versions of transactions,
prices and countries it was computed from, so the next load can tell what has changed since:

* months in which valid transactions came, went or were replaced, as the ingest notes them,
* months of prices that differ between the two price tables, told by number of rows and two 64-bit hashes of each month,
* months with transactions of a country that is listed more or less often than before.

The fact's version is written last. A load that dies before it is simply done again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark import schemas, versions
from tillmark.functions.dates import month_key
from tillmark.operators import dimensions, fact
from tillmark.operators.digests import digest
from tillmark.operators.reference_check import in_reference
from tillmark.sinks import transactions
from tillmark.sinks.layers import write_layer
from tillmark.sinks.metrics import write_counted
from tillmark.sources.layers import read_layer

FACT = "fct_sales"
SOURCES = ("transactions", "products", "countries")


@dataclass(frozen=True)
class Sources:
    """Folders of the bronze tables and the versions of them that a load works on."""

    spark: SparkSession
    lake: str
    version: dict[str, versions.Version]

    @staticmethod
    def latest(spark: SparkSession, lake: str) -> Sources:
        return Sources(spark, lake, {name: versions.latest(spark, f"{lake}/{name}") for name in SOURCES})

    def layer(self, name: str, number: int | None = None) -> DataFrame:
        path = f"{self.lake}/{name}"
        version = self.version[name] if number is None else versions.at(self.spark, path, number)
        return versions.read(self.spark, path, version)

    def transactions(self, months: set[str] | None = None) -> DataFrame:
        """Valid transactions, all or those of some months; only the folders of these months are read."""
        stored = transactions.read_transactions(
            self.spark,
            f"{self.lake}/transactions",
            transactions.VALID,
            None if months is None else in_months(months),
            self.version["transactions"],
        )
        return stored.select(*schemas.TRANSACTIONS.names)

    def prices(self, months: set[str] | None = None) -> DataFrame:
        """Prices, all or those of some months."""
        products = self.layer("products")
        if months is None:
            return products
        numbers = sorted(int(month) for month in months if month != transactions.NO_MONTH)
        if not numbers:
            return products.limit(0)
        # Bounds that the reader can hold against the statistics of row groups, then the months themselves.
        first, last = (F.make_date(F.lit(n // 100), F.lit(n % 100), F.lit(1)) for n in (numbers[0], numbers[-1]))
        within = (F.col("Date") >= first) & (F.col("Date") <= F.last_day(last))
        return products.filter(within & month_key(F.col("Date")).isin(numbers))


def in_months(months: set[str]):
    """The condition that a stored transaction lies in one of some months; those without a date are one too."""
    numbers = sorted(int(month) for month in months if month != transactions.NO_MONTH)
    dated = F.col("invoice_month").isin(numbers)
    return dated | F.col("invoice_month").isNull() if transactions.NO_MONTH in months else dated


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that are in one frame more often than in the other. Rows are counted, old ones downwards: no join."""
    signed = [frame.select("*", F.lit(sign).alias("sign")) for frame, sign in ((old, -1), (new, 1))]
    sums = signed[0].unionAll(signed[1]).groupBy(*new.columns).agg(F.sum("sign").alias("sign"))
    return sums.filter("sign <> 0").drop("sign")


def price_months(old: DataFrame, new: DataFrame) -> set[str]:
    """Months of prices that came, went or changed; at most as many as there are months.

    A month's rows (product, day, price) are compared by their number and two hashes that no order of rows changes, so
    what moves is one row per month and task instead of every price of both tables.
    """
    digests = []
    for frame in (old, new):
        prices = frame.select("StockCode", "Date", "UnitPrice").filter("Date IS NOT NULL")
        by_month = prices.groupBy(month_key(F.col("Date")).alias("month"))
        digests.append({row.month: tuple(row) for row in by_month.agg(*digest(prices)).collect()})
    before, after = digests
    return {str(month) for month in before.keys() | after.keys() if before.get(month) != after.get(month)}


def country_months(sources: Sources, old: DataFrame, new: DataFrame) -> set[str]:
    """Months with transactions of a country that is in the dimension more or less often than it was."""
    counts = [
        dimensions.dim_geography(frame).groupBy("geo_id").agg(F.count(F.lit(1)).alias("rows")) for frame in (old, new)
    ]
    changed = _differing(*counts).select("geo_id").filter("geo_id IS NOT NULL").distinct()
    if changed.isEmpty():
        return set()
    sold = in_reference(sources.transactions().select("CountryID", "InvoiceTimestamp"), changed, "CountryID", "geo_id")
    months = sold.select(month_key(F.col("InvoiceTimestamp")).alias("month")).distinct().collect()
    return {str(row.month) for row in months if row.month is not None}


def touched_months(sources: Sources, before: versions.Version) -> set[str] | None:
    """Months to compute anew since the fact's version ``before``; None for all, where there is nothing to compare."""
    loaded = before.content.get("loaded")
    if not loaded:
        return None
    spark, lake = sources.spark, sources.lake
    content = transactions.contents(sources.version["transactions"])
    months = transactions.changed_months(content, loaded["transactions"])
    for name in ("products", "countries"):
        if loaded[name] == sources.version[name].number:
            continue
        if loaded[name] not in versions.numbers(spark, f"{lake}/{name}"):
            return None
        old, new = sources.layer(name, loaded[name]), sources.layer(name)
        months |= price_months(old, new) if name == "products" else country_months(sources, old, new)
    return months


def _date_rows(sources: Sources, gold: str, months: set[str]) -> DataFrame:
    """The date dimension: days of other months as they are, those of ``months`` from their transactions."""
    stored = read_layer(sources.spark, "dim_date", gold)
    day = F.col("full_date")
    own = F.when(day.isNull(), F.lit(transactions.NO_MONTH)).otherwise(month_key(day).cast("string"))
    return stored.filter(~own.isin(sorted(months))).unionAll(dimensions.dim_date(sources.transactions(months)))


def _customer_rows(sources: Sources, gold: str, months: set[str], shrunk: bool) -> DataFrame:
    """The customers: those known and those of ``months``; of all transactions if some may have gone."""
    if shrunk:
        return dimensions.dim_customers(sources.transactions())
    stored = read_layer(sources.spark, "dim_customers", gold)
    return stored.unionAll(dimensions.dim_customers(sources.transactions(months))).distinct()


def fact_of_months(sources: Sources, months: set[str] | None) -> DataFrame:
    """The fact's rows of some months or all, without the columns that ``fact.with_derived`` adds."""
    geography = dimensions.dim_geography(sources.layer("countries"))
    return fact.priced_sales(sources.transactions(months), sources.prices(months), geography)


def _load_fact(sources: Sources, path: str, before: versions.Version, months: set[str] | None) -> int:
    """Compute the months anew and make them live together with what they were computed from; returns all rows."""
    spark = sources.spark
    kept = {} if months is None else {m: one for m, one in before.content["months"].items() if m not in months}
    if months is None or months:
        folder = versions.new_folder()
        sold = fact_of_months(sources, months).withColumn("sale_month", F.floor(F.col("date_id") / 100).cast("int"))
        write_layer(sold, folder, path, partition_by=["sale_month"], derive=fact.with_derived)
        stored = spark.read.schema(f"sale_month int, {_ddl(schemas.FCT_SALES)}").parquet(f"{path}/{folder}")
        for row in stored.groupBy("sale_month").agg(F.count(F.lit(1)).alias("row_count")).collect():
            kept[str(row.sale_month)] = {
                "part": f"{folder}/sale_month={row.sale_month}",
                "row_count": row.row_count,
            }
    content = {
        "parts": [kept[month]["part"] for month in sorted(kept)],
        "schema": schemas.FCT_SALES.jsonValue(),
        "months": kept,
        "loaded": {name: version.number for name, version in sources.version.items()},
    }
    versions.commit(spark, path, content, before)
    versions.tidy(spark, path)
    return sum(one["row_count"] for one in kept.values())


def _ddl(schema) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)


def refresh_star(spark: SparkSession, lake: str, gold: str) -> dict[str, int]:
    """Bring the five tables of the star schema under ``gold`` up to date; returns the rows that each has.

    The first load computes everything, as does one that finds an older price or country table cleared away.
    """
    sources = Sources.latest(spark, lake)
    before = versions.latest(spark, f"{gold}/{FACT}")
    months = touched_months(sources, before)
    loaded = before.content.get("loaded", {})
    shrunk = transactions.contents(sources.version["transactions"])["shrunk"] > loaded.get("transactions", -1)
    tables: dict[str, DataFrame] = {}
    if months is None:
        sold = sources.transactions()
        tables |= {"dim_date": dimensions.dim_date(sold), "dim_customers": dimensions.dim_customers(sold)}
    elif loaded["transactions"] != sources.version["transactions"].number:
        own = transactions.changed_months(
            transactions.contents(sources.version["transactions"]), loaded["transactions"]
        )
        tables["dim_date"] = _date_rows(sources, gold, own)
        tables["dim_customers"] = _customer_rows(sources, gold, own, shrunk)
    if loaded.get("products") != sources.version["products"].number:
        tables["dim_products"] = dimensions.dim_products(sources.layer("products"))
    if loaded.get("countries") != sources.version["countries"].number:
        tables["dim_geography"] = dimensions.dim_geography(sources.layer("countries"))
    counts = {}
    for name in ("dim_date", "dim_customers", "dim_products", "dim_geography"):
        if name in tables:
            counts[name] = write_counted(tables[name], lambda df, name=name: write_layer(df, name, gold))
        else:
            counts[name] = read_layer(spark, name, gold).count()
    return {**counts, FACT: _load_fact(sources, f"{gold}/{FACT}", before, months)}
