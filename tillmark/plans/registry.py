"""Every operator as a query over the order tables; ``oracle`` holds the SQL that each must agree with.

Queries that go through files or streams write what they need under the shared folder first, from the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.operators import alerts, bronze, dimensions, fact, outliers, reference_check, sales, trends
from tillmark.operators.flaws import latest_metrics
from tillmark.plans import backup, daily, ledger
from tillmark.plans.daily import DailyRun, run_daily
from tillmark.plans.dashboard import dashboard
from tillmark.plans.snapshot import snapshot
from tillmark.plans.trending import refresh_trends
from tillmark.plans.warehouse import load_measured, star_schema
from tillmark.session import scratch_path
from tillmark.sinks import transactions
from tillmark.sinks.layers import write_layer
from tillmark.sinks.metrics import record
from tillmark.sinks.reports import write_invalid_country_report, write_outlier_report
from tillmark.sources import files
from tillmark.sources.layers import read_layer, read_quantity_histogram, read_quarantine, read_valid_transactions
from tillmark.sources.messages import read_archive, read_archive_from, stream_archive
from tillmark.sources.star_tables import INVALID_COUNTRY, PART_KEYWORDS, StarTables
from tillmark.streaming.ingest import compact_transactions, ingest_new_files, replay_countries
from tillmark.streaming.trends import start_trends

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


class _Data:
    """The tables of a folder and the frames that several queries start from."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.tables = StarTables(spark, folder)

    @cached_property
    def parsed(self) -> DataFrame:
        return bronze.parse_transactions(self.tables.raw_transactions())

    @cached_property
    def countries(self) -> DataFrame:
        return bronze.countries(self.tables.raw_countries())

    @cached_property
    def products(self) -> DataFrame:
        return bronze.products(self.tables.raw_products())

    @cached_property
    def valid(self) -> DataFrame:
        return reference_check.in_reference(self.parsed, self.countries, "CountryID")

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.valid)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return dimensions.dim_customers(self.valid)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.products)

    @cached_property
    def dim_geography(self) -> DataFrame:
        return dimensions.dim_geography(self.countries)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return fact.fct_sales(self.valid, self.products, self.dim_geography)

    @property
    def star(self) -> dict[str, DataFrame]:
        return star_schema(self.valid, self.products, self.countries)

    @cached_property
    def invalid(self) -> DataFrame:
        # On the unfiltered rows: those that passed the ingest check have a country by definition.
        invalid = reference_check.missing_reference(self.parsed, self.dim_geography, "CountryID", "geo_id")
        return invalid.select(*alerts.INVALID_COUNTRY_COLUMNS)

    @cached_property
    def outliers(self) -> DataFrame:
        return outliers.quantity_outliers(self.valid)


def _query(function: Callable[[_Data], DataFrame]) -> Callable[[_Data], DataFrame]:
    QUERIES[function.__name__] = lambda spark, folder: function(_Data(spark, folder))
    return function


# --- sources -------------------------------------------------------------------------------------------------------


@_query
def raw_transactions_csv(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "raw_transactions")
    data.tables.raw_transactions().write.csv(path)
    return files.read_transactions(data.spark, path)


@_query
def raw_countries_csv(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "raw_countries")
    data.tables.raw_countries().write.option("header", True).csv(path)
    return files.read_countries(data.spark, path)


@_query
def raw_products_csv(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "raw_products")
    data.tables.raw_products().write.option("header", True).csv(path)
    return files.read_products(data.spark, path)


@_query
def layer_round_trip(data: _Data) -> DataFrame:
    root = scratch_path(data.spark, "lake")
    write_layer(data.products, "products", root)
    return read_layer(data.spark, "products", root)


@_query
def layer_append(data: _Data) -> DataFrame:
    """Both sides of the country check appended to one layer: together they are the input."""
    root = scratch_path(data.spark, "lake")
    for part in reference_check.split_by_reference(data.parsed, data.countries, "CountryID"):
        write_layer(part, "transactions", root, mode="append")
    return read_layer(data.spark, "transactions", root)


@_query
def message_log(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "messages")
    data.tables.messages().write.parquet(path)
    log = read_archive(data.spark, path)
    return log.select("topic", "partition", "offset", F.col("value").cast("string").alias("message"))


# --- bronze --------------------------------------------------------------------------------------------------------


@_query
def transactions_parsed(data: _Data) -> DataFrame:
    return data.parsed


@_query
def countries_bronze(data: _Data) -> DataFrame:
    return data.countries


@_query
def products_bronze(data: _Data) -> DataFrame:
    return data.products


@_query
def transactions_valid(data: _Data) -> DataFrame:
    return data.valid


@_query
def transactions_quarantine(data: _Data) -> DataFrame:
    return reference_check.missing_reference(data.parsed, data.countries, "CountryID")


@_query
def transactions_tagged(data: _Data) -> DataFrame:
    tagged = reference_check.tag_by_reference(data.parsed, data.countries, "CountryID", "is_valid")
    return tagged.groupBy("is_valid", "CountryID").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("Quantity").alias("quantity")
    )


# --- gold ----------------------------------------------------------------------------------------------------------


@_query
def dim_date(data: _Data) -> DataFrame:
    return data.dim_date


@_query
def dim_customers(data: _Data) -> DataFrame:
    return data.dim_customers


@_query
def dim_products(data: _Data) -> DataFrame:
    return data.dim_products


@_query
def dim_geography(data: _Data) -> DataFrame:
    return data.dim_geography


@_query
def fct_sales(data: _Data) -> DataFrame:
    return data.fct_sales


@_query
def fct_sales_with_date_lookup(data: _Data) -> DataFrame:
    return fact.fct_sales(data.valid, data.products, data.dim_geography, data.dim_date)


@_query
def unpriced_sales(data: _Data) -> DataFrame:
    missing = fact.unpriced_sales(data.valid, data.products)
    return missing.select("InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "CustomerID")


@_query
def repeated_sale_ids(data: _Data) -> DataFrame:
    return fact.repeated_sale_ids(data.fct_sales)


@_query
def product_uniqueness(data: _Data) -> DataFrame:
    return fact.product_uniqueness(data.dim_products)


@_query
def layer_row_counts(data: _Data) -> DataFrame:
    frames = {"transactions": data.valid, "countries": data.countries, **data.star}
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, counts)


# --- quality -------------------------------------------------------------------------------------------------------


@_query
def product_quantity_stats(data: _Data) -> DataFrame:
    stats = outliers.group_statistics(data.valid)
    return stats.withColumn("stddev_quantity", F.round("stddev_quantity", 6))


@_query
def quantity_outliers(data: _Data) -> DataFrame:
    return data.outliers


@_query
def outlier_report_lines(data: _Data) -> DataFrame:
    return alerts.outlier_lines(data.outliers)


@_query
def outlier_report_file(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "outliers")
    write_outlier_report(data.outliers, path)
    return data.spark.read.text(path).withColumnRenamed("value", "line")


@_query
def missing_country_refs(data: _Data) -> DataFrame:
    return data.invalid


@_query
def invalid_country_report_file(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "invalid_country")
    write_invalid_country_report(data.invalid, path)
    return data.spark.read.option("header", True).csv(path)


@_query
def alert_digest(data: _Data) -> DataFrame:
    return alerts.alert_digest(data.outliers, data.invalid)


@_query
def alert_lines(data: _Data) -> DataFrame:
    return alerts.alert_lines(data.outliers, data.invalid)


# --- sales questions -----------------------------------------------------------------------------------------------


@_query
def sales_by_day(data: _Data) -> DataFrame:
    return sales.sales_by_day(data.fct_sales, data.dim_date)


@_query
def sales_by_product(data: _Data) -> DataFrame:
    return sales.sales_by_product(data.fct_sales, data.dim_products)


@_query
def top_products(data: _Data) -> DataFrame:
    return sales.top_products(data.fct_sales, data.dim_products)


@_query
def sales_by_country(data: _Data) -> DataFrame:
    return sales.sales_by_country(data.fct_sales, data.dim_geography)


@_query
def sales_by_customer(data: _Data) -> DataFrame:
    return sales.sales_by_customer(data.fct_sales)


@_query
def top_customers(data: _Data) -> DataFrame:
    return sales.top_customers(data.fct_sales)


# --- trends --------------------------------------------------------------------------------------------------------


@_query
def product_mentions(data: _Data) -> DataFrame:
    return trends.mentions(data.tables.messages(), PART_KEYWORDS)


@_query
def trending_products(data: _Data) -> DataFrame:
    return trends.trending_products(data.tables.messages(), PART_KEYWORDS)


@_query
def trending_streaming(data: _Data) -> DataFrame:
    path = scratch_path(data.spark, "trends")
    data.tables.messages().write.parquet(f"{path}/messages")
    # A session of its own, so that the few counts are not spread over the caller's number of shuffle partitions.
    session = data.spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    query = start_trends(
        stream_archive(session, f"{path}/messages"),
        lambda table: write_layer(table, "trending_products", path),
        f"{path}/checkpoint",
        PART_KEYWORDS,
    )
    query.awaitTermination()
    return read_layer(data.spark, "trending_products", path)


#: Partitions that the ledger's message log is dealt out to.
PARTITIONS = 4


def _archived(data: _Data, path: str) -> Iterator[str]:
    """An archive of all messages in ``PARTITIONS`` partitions, after each of ``DROPS`` deliveries in order of offset."""
    log = data.tables.messages().withColumn("partition", F.pmod("offset", F.lit(PARTITIONS)).cast("int"))
    last = log.agg(F.max("offset")).first()[0] or 0
    drop = F.floor(F.col("offset") * DROPS / F.lit(last + 1))
    for number in range(DROPS):
        log.filter(drop == number).write.mode("append").parquet(f"{path}/messages")
        yield f"{path}/messages"


def _kept_ledger(data: _Data) -> str:
    """Where the trend table and its ledger lie after a run for each delivery, and one more that finds nothing new."""
    path = scratch_path(data.spark, "ledger")
    for archive in _archived(data, path):
        for _ in range(2):
            ledger.refresh_from_ledger(
                data.spark,
                lambda offsets, archive=archive: read_archive_from(data.spark, archive, offsets),
                lambda df, name: write_layer(df, name, path),
                f"{path}/ledger",
                PART_KEYWORDS,
            )
    return path


@_query
def trending_ledger(data: _Data) -> DataFrame:
    """The trend table after several runs, each of which read the messages that came since the one before."""
    return read_layer(data.spark, "trending_products", _kept_ledger(data))


@_query
def trend_offsets(data: _Data) -> DataFrame:
    """Up to where the ledger has counted each partition."""
    offsets = ledger.counted_offsets(data.spark, f"{_kept_ledger(data)}/ledger")
    rows = [(topic, partition, following) for (topic, partition), following in offsets.items()]
    return data.spark.createDataFrame(rows, "topic string, partition int, next_offset bigint")


@_query
def dashboard_trends(data: _Data) -> DataFrame:
    """The trend table as the dashboard reads it, from where a refresh stored it."""
    gold = scratch_path(data.spark, "dashboard")
    refresh_trends(data.tables.messages(), lambda df, name: write_layer(df, name, gold), PART_KEYWORDS)
    # The star schema is built of stored bronze tables, as the jobs do it: raw inputs are derived once, not per table.
    lake = f"{gold}/bronze"
    for name, df in {"transactions": data.valid, "products": data.products, "countries": data.countries}.items():
        write_layer(df, name, lake)
    stored = [read_layer(data.spark, name, lake) for name in ("transactions", "products", "countries")]
    for name, df in star_schema(*stored).items():
        write_layer(df, name, gold)
    return dashboard(data.spark, gold)["trending_products"]


#: How raw files are compressed. Each is read by one task, and there are as many as tasks that wrote them.
RAW_COMPRESSION = "gzip"


# --- jobs ----------------------------------------------------------------------------------------------------------


def _ingest(data: _Data) -> str:
    """Ingest the tables from CSV files, then once more; the second run finds no new file and must add nothing."""
    path = scratch_path(data.spark, "ingest")
    data.tables.raw_transactions().write.csv(f"{path}/raw")
    for _ in range(2):
        raw = files.stream_transactions(data.spark, f"{path}/raw")
        ingest_new_files(raw, data.countries, f"{path}/transactions", f"{path}/checkpoint")
    return f"{path}/transactions"


@_query
def ingest_incremental(data: _Data) -> DataFrame:
    return read_valid_transactions(data.spark, _ingest(data))


@_query
def ingest_incremental_quarantine(data: _Data) -> DataFrame:
    return read_quarantine(data.spark, _ingest(data))


#: Deliveries that the raw transactions come in.
DROPS = 3


def _drops(data: _Data, path: str) -> Iterator[str]:
    """The raw files after each of ``DROPS`` deliveries, which together are all raw transactions; each holds invoices of
    all months. They are written once, and a pattern of folders names those that have come."""
    drop = F.pmod(F.xxhash64("InvoiceNo"), F.lit(DROPS))
    raw = data.tables.raw_transactions().withColumn("drop", drop)
    raw.write.partitionBy("drop").option("compression", RAW_COMPRESSION).csv(f"{path}/raw")
    for number in range(DROPS):
        yield f"{path}/raw/drop=[0-{number}]"


def _ingest_drops(data: _Data, countries: DataFrame, merged: bool = True) -> str:
    """Ingest the deliveries one after the other, each a batch, and merge the batches."""
    path = scratch_path(data.spark, "ingest-drops")
    for folder in _drops(data, path):
        raw = files.stream_transactions(data.spark, folder)
        ingest_new_files(raw, countries, f"{path}/transactions", f"{path}/checkpoint")
    if merged:
        compact_transactions(data.spark, f"{path}/transactions", fan_in=DROPS)
    return f"{path}/transactions"


@_query
def ingest_compacted(data: _Data) -> DataFrame:
    """Valid transactions of many batches after their folders were merged."""
    return read_valid_transactions(data.spark, _ingest_drops(data, data.countries))


@_query
def ingest_quantity_stats(data: _Data) -> DataFrame:
    """Median and deviation per product from the histogram that the ingest keeps; no transaction is read for them."""
    histogram = read_quantity_histogram(data.spark, _ingest_drops(data, data.countries))
    stats = outliers.histogram_statistics(histogram)
    return stats.withColumn("stddev_quantity", F.round("stddev_quantity", 6))


@_query
def ingest_replayed(data: _Data) -> DataFrame:
    """Both sides of the country check after the country table was put right: ingested while it listed the invalid
    country and lacked all of Asia, then judged again."""
    wrong = data.countries.filter(F.col("ContinentName") != "Asia").select("CountryID")
    invalid = data.spark.createDataFrame([(INVALID_COUNTRY,)], "CountryID string")
    path = _ingest_drops(data, wrong.unionAll(invalid), merged=False)
    replay_countries(data.countries, path)
    compact_transactions(data.spark, path, fan_in=DROPS)
    return _both_sides(data, path)


def _both_sides(data: _Data, path: str) -> DataFrame:
    """Valid and quarantined transactions of a table, told apart by ``quality``."""
    sides = {"valid": read_valid_transactions, "quarantine": read_quarantine}
    tagged = [read(data.spark, path).withColumn("quality", F.lit(name)) for name, read in sides.items()]
    return tagged[0].unionAll(tagged[1])


@_query
def daily_sales_incremental(data: _Data) -> DataFrame:
    """The fact after three loads, of which only the first computes everything: late invoices come with each, and a
    third of the prices is wrong until the last. Prices are derived once: those that stay, and two states of the rest."""
    path = scratch_path(data.spark, "daily-incremental")
    data.tables.raw_countries().write.option("header", True).csv(f"{path}/countries")
    corrected = F.pmod(F.xxhash64("StockCode"), F.lit(3)) == 0
    states = F.when(corrected, F.array(F.lit("wrong"), F.lit("right"))).otherwise(F.array(F.lit("both")))
    price = F.when(F.col("state") == "wrong", F.lit("0.01")).otherwise(F.col("UnitPrice"))
    raw_products = data.tables.raw_products().withColumn("state", F.explode(states)).withColumn("UnitPrice", price)
    raw = raw_products.write.partitionBy("state").option("compression", RAW_COMPRESSION)
    raw.option("header", True).csv(f"{path}/products")
    for number, folder in enumerate(_drops(data, path)):
        prices = "right" if number == DROPS - 1 else "wrong"
        products = f"{path}/products/state={{both,{prices}}}"
        run = DailyRun(folder, f"{path}/countries", products, f"{path}/lake")
        daily.refresh_dimensions(data.spark, run)
        daily.ingest_transactions(data.spark, run)
        daily.refresh_gold(data.spark, run)
    return read_layer(data.spark, "fct_sales", run.gold)


@_query
def backup_restored(data: _Data) -> DataFrame:
    """Both sides of the country check in a lake that was put back from its backups: one for each delivery, which copies
    what the one before it didn't have, and one after the batches were merged."""
    path = scratch_path(data.spark, "backup")
    lake, destination = f"{path}/lake", f"{path}/backup"
    for folder in _drops(data, path):
        raw = files.stream_transactions(data.spark, folder)
        ingest_new_files(raw, data.countries, f"{lake}/transactions", f"{path}/checkpoint")
        backup.backup(data.spark, lake, destination)
    compact_transactions(data.spark, f"{lake}/transactions", fan_in=DROPS)
    backup.backup(data.spark, lake, destination)
    backup.restore(data.spark, destination, f"{path}/restored")
    return _both_sides(data, f"{path}/restored/transactions")


@_query
def snapshot_manifest(data: _Data) -> DataFrame:
    valid, quarantined = reference_check.split_by_reference(data.parsed, data.countries, "CountryID")
    tables = {
        "countries": data.countries,
        "products": data.products,
        "transactions": valid,
        "quarantine": quarantined,
    }
    return snapshot(data.spark, tables, scratch_path(data.spark, "snapshot"), "2024-01-01-000000")


def _daily_run(data: _Data) -> tuple[DailyRun, dict[str, int]]:
    """A whole daily run over CSV files made from the tables."""
    path = scratch_path(data.spark, "daily")
    run = DailyRun(f"{path}/raw/transactions", f"{path}/raw/countries", f"{path}/raw/products", f"{path}/lake")
    data.tables.raw_transactions().write.option("compression", RAW_COMPRESSION).csv(run.raw_transactions)
    data.tables.raw_countries().write.option("header", True).csv(run.raw_countries)
    data.tables.raw_products().write.option("header", True).option("compression", RAW_COMPRESSION).csv(run.raw_products)
    return run, run_daily(data.spark, run)


@_query
def daily_run_metrics(data: _Data) -> DataFrame:
    """Rows per table that a daily run writes. In how many batches they came depends on their size, so that is left out."""
    _, metrics = _daily_run(data)
    metrics.pop("ingest_batches")
    return data.spark.createDataFrame(sorted(metrics.items()), "metric string, row_count bigint")


@_query
def kept_metrics(data: _Data) -> DataFrame:
    """What the writes of bronze tables have counted, kept over several runs: the last state of each table, and how many
    runs are kept."""
    path = scratch_path(data.spark, "metrics")
    # Raw prices are derived once; each run parses them anew.
    data.tables.raw_products().write.parquet(f"{path}/raw-products")
    frames = {
        "countries": data.countries,
        "products": bronze.products(data.spark.read.parquet(f"{path}/raw-products")),
    }
    for folder in _drops(data, path):
        measured = load_measured(frames, lambda df, name: write_layer(df, name, path))
        raw = files.stream_transactions(data.spark, folder)
        ingest_new_files(raw, data.countries, f"{path}/transactions", f"{path}/checkpoint")
        compact_transactions(data.spark, f"{path}/transactions", fan_in=2)
        measured["transactions"] = transactions.measured(data.spark, f"{path}/transactions")
        record(data.spark, f"{path}/metrics", measured)
    metrics = read_layer(data.spark, "metrics", path)
    return latest_metrics(metrics).withColumn("runs", F.lit(metrics.select("run").distinct().count()).cast("long"))


@_query
def daily_run_sales(data: _Data) -> DataFrame:
    """The fact as a daily run stores it."""
    run, _ = _daily_run(data)
    return read_layer(data.spark, "fct_sales", run.gold)
