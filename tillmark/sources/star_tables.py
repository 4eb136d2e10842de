"""The raw retail inputs, derived from order tables (lineitem, orders, customer, nation, part).

Only the shape changes: every line item becomes one raw transaction, every nation a country, and every product sold
on a day a price. The tables hold no dirty text, so rules on remainders put some in; every row stays:

* invoices whose number is a multiple of 12 name a country that does not exist,
* one in 25 (remainder 3) has no region, one in 50 (remainder 7) an unreadable date, one in 40 (remainder 9) no quantity,
* parts whose number is a multiple of 20 have prices with unreadable dates, one in 30 (remainder 11) unreadable prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions import parsing

# Continent code by region number, and the code of an invalid country.
CONTINENT_CODES = {0: "22", 1: "55", 2: "33", 3: "11", 4: "13"}
INVALID_COUNTRY = "9999"

# Text that is no date and no price.
UNREADABLE_DATE_FORMAT = "yyyy.MM.dd"
UNREADABLE_PRICE = "n/a"

# Keywords found in part names. A later entry wins over an earlier one.
PART_KEYWORDS = (("red", "red"), ("ring", "ring"), ("widget", "widget"), ("gizmo", "gizmo"))


def _every(key: str, n: int, remainder: int = 0) -> Column:
    return F.col(key) % n == remainder


def _country_code() -> Column:
    region = F.col("n_regionkey")
    continent = F.coalesce(*[F.when(region == number, F.lit(code)) for number, code in CONTINENT_CODES.items()])
    return F.concat(continent, F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))


class StarTables:
    """The order tables of one folder, each opened once, and the raw inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def raw_countries(self) -> DataFrame:
        return self.table("nation").select(_country_code().alias("CountryID"), F.col("n_name").alias("CountryName"))

    def raw_transactions(self) -> DataFrame:
        """One raw transaction per line item. Orders get their country first, so line items are shuffled once."""
        region_id = (F.col("n_regionkey") + 1).cast("string")
        nation = self.table("nation").select("n_nationkey", _country_code().alias("code"), region_id.alias("region"))
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        readable = F.date_format("o_orderdate", parsing.INVOICE_DATE_FORMAT)
        unreadable = F.date_format("o_orderdate", UNREADABLE_DATE_FORMAT)
        orders = self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            F.when(_every("o_orderkey", 50, 7), unreadable).otherwise(readable).alias("InvoiceDate"),
        )
        code = F.when(_every("o_orderkey", 12), F.lit(INVALID_COUNTRY)).otherwise(F.col("code"))
        # A NULL region leaves the separator out as well.
        region = F.when(~_every("o_orderkey", 25, 3), F.col("region"))
        quantity = F.when(~_every("o_orderkey", 40, 9), F.col("l_quantity").cast("int"))
        customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        invoices = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        lines = self.table("lineitem").join(invoices, F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(
            F.col("o_orderkey").cast("string").alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            quantity.alias("Quantity"),
            "InvoiceDate",
            F.col("o_custkey").cast("string").alias("CustomerID"),
            F.concat_ws(parsing.COUNTRY_SEPARATOR, code, region).alias("Country"),
        )

    def raw_products(self) -> DataFrame:
        """A price for every product and day of sale."""
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        sold = self.table("lineitem").select("l_orderkey", "l_partkey")
        days = sold.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "o_orderdate")
        part = self.table("part").select("p_partkey", "p_name", "p_retailprice")
        price = F.col("p_retailprice").try_cast(parsing.PRICE_TYPE).cast("string")
        day = F.date_format("o_orderdate", parsing.PRICE_DATE_FORMAT)
        unreadable = F.date_format("o_orderdate", UNREADABLE_DATE_FORMAT)
        return days.distinct().join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("ProductDescription"),
            F.when(_every("l_partkey", 30, 11), F.lit(UNREADABLE_PRICE)).otherwise(price).alias("UnitPrice"),
            F.when(_every("l_partkey", 20), unreadable).otherwise(day).alias("Date"),
        )

    def messages(self) -> DataFrame:
        """Part names as a message log; only ``value`` matters, the other columns are those every log has."""
        return self.table("part").select(
            F.lit(None).cast("binary").alias("key"),
            F.col("p_name").cast("binary").alias("value"),
            F.lit("part_names").alias("topic"),
            F.lit(0).alias("partition"),
            F.col("p_partkey").alias("offset"),
            F.timestamp_seconds(F.lit(0)).alias("timestamp"),
            F.lit(0).alias("timestampType"),
        )
